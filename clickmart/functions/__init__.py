"""Column expressions (all built-in Spark functions, no UDFs)."""

from clickmart.functions.text import (
    clean_event_type,
    initcap_words,
    parent_page_title,
    page_title,
)
from clickmart.functions.timefn import epoch_seconds, file_hour, whole_second_diff
from clickmart.functions.variant import json_int, json_string, json_timestamp, property_path

__all__ = [
    "clean_event_type", "initcap_words", "page_title", "parent_page_title",
    "epoch_seconds", "file_hour", "whole_second_diff",
    "json_int", "json_string", "json_timestamp", "property_path",
]

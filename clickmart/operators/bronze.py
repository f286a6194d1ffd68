"""raw -> bronze: typed extraction, event-type cleaning, file-hour stamp."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.text import clean_event_type
from clickmart.functions.timefn import file_hour
from clickmart.functions.variant import json_int, json_string, json_timestamp, property_path


def load_time(load_ts: datetime | str | None) -> Column:
    """The load stamp of a run: a fixed value when given (reproducible runs),
    else the current wall-clock time without zone."""
    if load_ts is None:
        return F.localtimestamp()
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def extract(raw: DataFrame, load_ts=None, strict: bool = True) -> DataFrame:
    """Typed columns out of ``json_data``; ``event_type`` still as sent."""
    v = F.col("json_data")
    top = ["device_id", "device_type", "device_family", "platform", "os_version",
           "os_name", "event_type"]
    return raw.select(
        json_string(v, "$.uuid", strict).alias("event_uuid"),
        json_string(v, "$.session_id", strict).alias("session_id"),
        *[json_string(v, f"$.{name}", strict).alias(name) for name in top],
        json_timestamp(v, "$.event_time", strict).alias("event_time"),
        json_string(v, property_path(S.PROPERTY_PAGE_URL), strict).alias("page_url"),
        json_int(v, property_path(S.PROPERTY_PAGE_COUNTER), strict).alias("page_counter"),
        json_string(v, property_path(S.PROPERTY_ELEMENT_TEXT), strict).alias("element_text"),
        json_string(v, property_path(S.PROPERTY_ELEMENT_TAG), strict).alias("element_tag"),
        json_string(v, property_path(S.PROPERTY_ELEMENT_HREF), strict).alias("element_url"),
        file_hour(F.col("filename")).alias("extract_timestamp"),
        load_time(load_ts).alias("load_timestamp"),
    ).select(S.BASE_COLUMNS)


def clean(extracted: DataFrame) -> DataFrame:
    """Replace ``event_type`` by its cleaned, title-cased form."""
    return extracted.withColumn("event_type", clean_event_type(F.col("event_type")))


def bronze(raw: DataFrame, load_ts=None, strict: bool = True) -> DataFrame:
    """``events_base``: the full raw -> bronze step (also the body of the
    streaming raw -> bronze query, as it is row-local)."""
    return clean(extract(raw, load_ts, strict))

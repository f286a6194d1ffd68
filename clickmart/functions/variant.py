"""Typed extraction from the semi-structured raw event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def property_path(key: str) -> str:
    """JSON path of a quoted key inside ``event_properties``."""
    return f"$.event_properties['{key}']"


def _get(v: Column, path: str, type_: str, strict: bool) -> Column:
    return (F.variant_get if strict else F.try_variant_get)(v, path, type_)


def json_string(v: Column, path: str, strict: bool = True) -> Column:
    """Scalar at ``path`` as text (numbers keep their digits); a missing path
    or JSON null gives NULL."""
    return _get(v, path, "string", strict)


def json_timestamp(v: Column, path: str, strict: bool = True) -> Column:
    """Timestamp text at ``path`` as a zone-free timestamp. Malformed text
    fails the job when ``strict`` (as a plain cast does), else gives NULL."""
    return _get(v, path, "timestamp_ntz", strict)


def json_int(v: Column, path: str, strict: bool = True) -> Column:
    """Number at ``path`` rounded half away from zero to a whole number
    (2.6 -> 3), not truncated."""
    return F.round(_get(v, path, "decimal(38,9)", strict), 0).cast("long")

"""Time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmart import schemas as S

_EPOCH = "1970-01-01 00:00:00"
_MICROS = 1_000_000


def file_hour(filename: Column) -> Column:
    """``yyyy-MM-dd_H`` (1- or 2-digit hour) found anywhere in a file path,
    as a zone-free timestamp; NULL when the path holds no such token.

    ``regexp_substr`` would do, but Spark computes its match in a projection of its own below
    the others, and a scan of the raw table then rebuilds every whole variant instead of
    reading the fields that are asked for."""
    token = F.get(F.regexp_extract_all(filename, F.lit(S.FILE_HOUR_PATTERN), F.lit(0)), F.lit(0))
    return F.to_timestamp_ntz(token, F.lit(S.FILE_HOUR_FORMAT))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch (floor), computed without a time zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts)
    return ((micros - F.pmod(micros, F.lit(_MICROS))) / F.lit(_MICROS)).cast("long")


def whole_second_diff(start: Column, end: Column) -> Column:
    """Seconds between two timestamps as the difference of their whole-second
    parts: 00:00:00.9 -> 00:00:02.1 counts 2."""
    return epoch_seconds(end) - epoch_seconds(start)

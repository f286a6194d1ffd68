"""Raw JSON events derived from the driver's ``events`` and ``pages`` tables.

The driver ships no clickstream in the raw vendor format, so each ``events``
row is turned into one JSON line of that format (mapping in FIXTURES.md §2).
Everything is a Spark projection plus one join; nothing is made up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def _monday(ts: Column) -> Column:
    # dayofweek: 1 = Sunday .. 7 = Saturday; Monday is 0 days back.
    return F.date_sub(F.to_date(ts), F.pmod(F.dayofweek(ts) + F.lit(5), F.lit(7)))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a source read as fewer partitions than the cluster has
    task slots (a small unsplittable file); a no-op for a large input."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def _vendor_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """``event`` (struct in the vendor's JSON shape) and ``filename`` per event."""
    ts, uid, eid = F.col("ts"), F.col("user_id"), F.col("event_id")
    day = F.dayofmonth(ts)
    linked = pages.select(F.col("page_id").alias("_page_id"), F.col("url").alias("_url"))
    # events link to all pages, 0 .. count - 1
    n_pages = pages.select(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")).scalar()
    ev = spread(events.select("event_id", "ts", "user_id", "event_type")).withColumn(
        "_page_id", F.pmod(uid + F.floor(day / F.lit(3)), n_pages))
    joined = ev.join(linked, "_page_id", "left")

    etype = F.col("event_type")
    is_click = etype == F.lit("click")
    url = _when(~etype.isin("signup", "error"), F.col("_url"))
    props = F.struct(
        url.alias(S.PROPERTY_PAGE_URL),
        _when(url.isNotNull(), F.pmod(eid, F.lit(10))).alias(S.PROPERTY_PAGE_COUNTER),
        _when(is_click, F.concat(F.lit("t"), F.pmod(eid, F.lit(5)))).alias(S.PROPERTY_ELEMENT_TEXT),
        _when(is_click, F.lit("a")).alias(S.PROPERTY_ELEMENT_TAG),
        _when(is_click, F.col("_url")).alias(S.PROPERTY_ELEMENT_HREF),
    )
    vendor_type = (
        F.when(etype == "view", F.lit(S.VENDOR_TAG_WITH_BLANK + "Page Viewed"))
        .when(etype == "click", F.lit(S.VENDOR_TAG_WITH_BLANK + "Element Clicked"))
        .when(etype == "signup", F.lit("sign_up"))
        .when(etype == "error", F.lit("error_raised"))
        .otherwise(etype)
    )
    event = F.struct(
        F.concat(F.lit("ev-"), eid.cast("string")).alias("uuid"),
        F.concat(uid.cast("string"), F.lit("-"), F.date_format(_monday(ts), "yyyyMMdd")).alias("session_id"),
        _when(F.pmod(eid, F.lit(101)) != 0,
              F.concat(F.lit("d"), (uid + F.when(F.pmod(eid, F.lit(17)) == 0, 1).otherwise(0)).cast("string"))
              ).alias("device_id"),
        F.concat(F.lit("m"), F.pmod(uid, F.lit(4))).alias("device_type"),
        F.concat(F.lit("f"), F.pmod(uid, F.lit(7))).alias("device_family"),
        F.when((day >= 20) & (F.pmod(uid, F.lit(5)) == 0), F.lit("Web")).otherwise(F.lit("iOS")).alias("platform"),
        F.concat(F.lit("1."), F.floor(day / F.lit(10)).cast("string")).alias("os_version"),
        _when(F.pmod(uid, F.lit(6)) != 0, F.concat(F.lit("os"), F.pmod(uid, F.lit(3)))).alias("os_name"),
        vendor_type.alias("event_type"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        props.alias("event_properties"),
    )
    filename = F.concat(F.lit("data/0_"), F.date_format(ts, "yyyy-MM-dd"), F.lit("_"),
                        F.hour(ts).cast("string"), F.lit("#0.json"))
    return joined.select(event.alias("event"), filename.alias("filename"))


def raw_json_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """``json_text`` (one vendor-format JSON object) and ``filename`` per
    event: the content of the files an exporter would deliver."""
    return _vendor_events(events, pages).select(F.to_json("event").alias("json_text"), "filename")


def raw_from_tables(events: DataFrame, pages: DataFrame) -> DataFrame:
    """The raw layer (``json_data variant, filename``) for the driver tables,
    as scanning those files would produce it (built as a variant directly,
    without the text round trip; absent and null fields read alike)."""
    return _vendor_events(events, pages).select(
        F.to_variant_object("event").alias("json_data"), "filename")


def write_json_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write JSON lines as text files, one folder per file-name hour token,
    so every written file path carries its hour (``hour=2024-01-01_3/...``).
    Rows are rebalanced by hour first: about one file per hour, as an
    exporter delivers them (AQE splits an hour too large for one file)."""
    token = F.regexp_substr(F.col("filename"), F.lit(S.FILE_HOUR_PATTERN))
    (lines.select(F.col("json_text").alias("value"), token.alias("hour"))
     .hint("rebalance", "hour")
     .write.mode(mode).partitionBy("hour").text(path))

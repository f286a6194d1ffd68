"""Registered queries over the driver's tables.

Each query takes ``(spark, sf_dir)``, derives the raw clickstream from the
``events`` and ``pages`` tables with Spark (FIXTURES.md §2) and runs one
operator or layer of the medallion over all of it. Load stamps are fixed so
results are reproducible; the incremental queries replay two deliveries:
files of hours before ``BATCH_CUT`` first, the rest second.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.text import clean_event_type
from clickmart.functions.timefn import file_hour
from clickmart.functions.variant import json_string
from clickmart.operators import gold, marks, merge, silver
from clickmart.operators.bronze import bronze, extract
from clickmart.plans import pipeline as P
from clickmart.plans import refresh, store
from clickmart.session import scratch_path
from clickmart.sources.driver_tables import raw_from_tables, raw_json_lines, write_json_lines  # noqa: F401
from clickmart.sources.raw import audit_of, list_files, load_audit, read_raw
from clickmart.streaming import feed
from clickmart.streaming.ingest import ingest_files, raw_to_base

LOAD_TS_1 = "2026-05-14 09:00:00"
LOAD_TS_2 = "2026-05-15 09:00:00"
BATCH_CUT = "2024-01-18 00:00:00"
# In the late-delivery replay, files of this hour of day before the cut
# arrive with the second delivery instead of the first.
LATE_HOUR = 23


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return events, pages


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_tables(*tables(spark, sf_dir))


def first_delivery(filename, late: bool = False):
    """True for rows of files delivered first: hours before the cut (and,
    in the late replay, not at ``LATE_HOUR``). Files without hour: second."""
    hour = file_hour(filename)
    cond = hour < F.lit(BATCH_CUT).cast("timestamp_ntz")
    if late:
        cond = cond & (F.hour(hour) != F.lit(LATE_HOUR))
    return F.coalesce(cond, F.lit(False))


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder: every branch
    of a query (fact, pages, devices, marks) reads the columns it needs from
    one bronze build, and lineage stops here."""
    path = scratch_path(df.sparkSession, "bronze")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Layers(dict):
    """Tables built on first use, so that a query starts no job of a layer it
    does not return."""

    def __init__(self, **build: Callable[[], DataFrame]):
        super().__init__()
        self.build = build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.build[name]()
        return self[name]


def _built(base: DataFrame, load_ts: str) -> Layers:
    t = Layers()
    t.build = {
        P.BASE: lambda: base,
        P.FACT: lambda: silver.fact(base, load_ts),
        P.PAGES: lambda: silver.pages(base, load_ts),
        P.DEVICES: lambda: silver.latest_devices(base, load_ts),
        P.ALL_EVENTS: lambda: gold.all_events(t[P.FACT], t[P.PAGES], t[P.DEVICES]),
        P.JOURNEY: lambda: gold.session_journey(t[P.FACT], t[P.PAGES], t[P.DEVICES]),
    }
    return t


def full(spark: SparkSession, sf_dir: str) -> Layers:
    return _built(materialized(bronze(raw(spark, sf_dir), LOAD_TS_1)), LOAD_TS_1)


def two_batch(spark: SparkSession, sf_dir: str, late: bool = False,
              prune: bool = True) -> dict[str, Layers]:
    """Initial build over the first delivery, then one refresh with the
    second. Returns the tables after each step and the refresh's appends."""
    r = raw(spark, sf_dir)
    first = first_delivery(F.col("filename"), late)
    base_all = materialized(bronze(r.where(first), LOAD_TS_1)
                            .unionByName(bronze(r.where(~first), LOAD_TS_2)))
    base1 = base_all.where(F.col("load_timestamp") == F.lit(LOAD_TS_1).cast("timestamp_ntz"))
    t1 = _built(base1, LOAD_TS_1)
    sil, after, gld = Layers(), Layers(), Layers()
    sil.build = {
        P.FACT: lambda: silver.fact_increment(base_all, t1[P.FACT], LOAD_TS_2),
        P.PAGES: lambda: silver.pages_increment(base_all, t1[P.PAGES], LOAD_TS_2),
        P.DEVICES: lambda: merge.merge_devices(t1[P.DEVICES],
                                               silver.latest_devices(base_all, LOAD_TS_2)),
    }
    gld.build = {
        P.ALL_EVENTS: lambda: gold.all_events_increment(
            after[P.FACT], after[P.PAGES], after[P.DEVICES], t1[P.ALL_EVENTS], prune=prune),
        P.JOURNEY: lambda: gold.session_journey_increment(
            after[P.FACT], after[P.PAGES], after[P.DEVICES], t1[P.JOURNEY]),
    }
    after.build = {
        P.BASE: lambda: base_all,
        P.FACT: lambda: t1[P.FACT].unionByName(sil[P.FACT]),
        P.PAGES: lambda: t1[P.PAGES].unionByName(sil[P.PAGES]),
        P.DEVICES: lambda: sil[P.DEVICES],
        P.ALL_EVENTS: lambda: t1[P.ALL_EVENTS].unionByName(gld[P.ALL_EVENTS]),
        P.JOURNEY: lambda: t1[P.JOURNEY].unionByName(gld[P.JOURNEY]),
    }
    return {"first": t1, "silver_appends": sil, "after": after, "gold_appends": gld}


# --- sources ---------------------------------------------------------------

def _raw_projection(raw_df: DataFrame) -> DataFrame:
    v = F.col("json_data")
    return raw_df.select(
        json_string(v, "$.uuid").alias("event_uuid"),
        json_string(v, "$.session_id").alias("session_id"),
        json_string(v, "$.device_id").alias("device_id"),
        F.regexp_substr(F.col("filename"), F.lit(S.FILE_HOUR_PATTERN)).alias("file_hour"),
    )


def q_raw_load(spark, sf_dir):
    """JSON lines written as hourly files, bulk-scanned back into raw."""
    path = scratch_path(spark, "rawfiles")
    write_json_lines(raw_json_lines(*tables(spark, sf_dir)), path)
    return _raw_projection(read_raw(spark, path))


def _write_delivery(spark, sf_dir, path, which: int):
    lines = raw_json_lines(*tables(spark, sf_dir))
    first = first_delivery(F.col("filename"))
    write_json_lines(lines.where(first if which == 1 else ~first), path, mode="append")


def q_stream_ingest(spark, sf_dir):
    """Two deliveries of files and three ``availableNow`` runs (the last
    with nothing new): every file lands in raw exactly once."""
    root = scratch_path(spark, "ingest")
    src, raw_dir, ck = f"{root}/landing", f"{root}/raw", f"{root}/_ck_ingest"
    _write_delivery(spark, sf_dir, src, 1)
    ingest_files(spark, src, raw_dir, ck)
    _write_delivery(spark, sf_dir, src, 2)
    ingest_files(spark, src, raw_dir, ck)
    ingest_files(spark, src, raw_dir, ck)
    return _raw_projection(spark.read.schema(S.RAW_SCHEMA).parquet(raw_dir))


def q_stream_raw_to_base(spark, sf_dir):
    """File ingest and raw -> bronze as two chained streams, run once per
    delivery; each delivery's rows carry that run's load stamp."""
    root = scratch_path(spark, "rawbase")
    src, raw_dir, base_dir = f"{root}/landing", f"{root}/raw", f"{root}/base"
    for which, load_ts in ((1, LOAD_TS_1), (2, LOAD_TS_2)):
        _write_delivery(spark, sf_dir, src, which)
        ingest_files(spark, src, raw_dir, f"{root}/_ck_ingest")
        raw_to_base(spark, raw_dir, base_dir, f"{root}/_ck_base", load_ts)
    return spark.read.parquet(base_dir).select(S.BASE_COLUMNS)


def q_stream_base_to_fact(spark, sf_dir):
    """The fact as a consumer of ``events_base``'s change feed with its own
    offset: it follows after the first delivery and after the second."""
    root = scratch_path(spark, "feed")
    src, raw_dir, base_dir, fact_dir = (f"{root}/{n}" for n in ("landing", "raw", "base", "fact"))
    schema = S.TABLE_DDL["events_base"]
    for which, load_ts in ((1, LOAD_TS_1), (2, LOAD_TS_2)):
        _write_delivery(spark, sf_dir, src, which)
        ingest_files(spark, src, raw_dir, f"{root}/_ck_ingest")
        raw_to_base(spark, raw_dir, base_dir, f"{root}/_ck_base", load_ts)
        feed.follow(spark.readStream.schema(schema).parquet(base_dir), fact_dir, f"{root}/_ck_fact",
                    lambda rows, load_ts=load_ts: silver.fact(rows, load_ts))
    return feed.read_followed(spark, fact_dir, S.TABLE_DDL["fct_all_session_events"])


def q_load_audit(spark, sf_dir):
    return load_audit(raw(spark, sf_dir))


def q_stage_listing(spark, sf_dir):
    """Both deliveries landed, only the first ingested: the listing audit
    shows every hour file, loaded ones with their rows, the rest with 0. The
    rows per file are those kept by the audit, brought up to date twice."""
    root = scratch_path(spark, "listing")
    src, raw_dir = f"{root}/landing", f"{root}/raw"
    _write_delivery(spark, sf_dir, src, 1)
    counts = f"{root}/counts"
    ingest_files(spark, src, raw_dir, f"{root}/_ck_ingest")
    feed.count_files(spark, raw_dir, counts, f"{root}/_ck_audit")
    _write_delivery(spark, sf_dir, src, 2)
    feed.count_files(spark, raw_dir, counts, f"{root}/_ck_audit")
    audit = audit_of(feed.counted_files(spark, counts), list_files(spark, src))
    token = F.regexp_substr(F.col("filename"), F.lit(S.FILE_HOUR_PATTERN))
    return audit.groupBy(token.alias("file_hour")).agg(
        F.sum("n_rows").alias("n_rows"), F.bool_and("listed").alias("listed"))


# --- bronze ----------------------------------------------------------------

def q_bronze_extract(spark, sf_dir):
    return extract(raw(spark, sf_dir), LOAD_TS_1)


def q_extract_timestamp(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(json_string(F.col("json_data"), "$.uuid").alias("event_uuid"), "filename",
                    file_hour(F.col("filename")).alias("extract_timestamp"))


def q_event_type_clean(spark, sf_dir):
    r = raw(spark, sf_dir)
    ex = extract(r, LOAD_TS_1).select("event_uuid", F.col("event_type").alias("event_type_raw"))
    return ex.select("event_uuid", "event_type_raw",
                     clean_event_type(F.col("event_type_raw")).alias("event_type"))


def q_bronze(spark, sf_dir):
    return bronze(raw(spark, sf_dir), LOAD_TS_1)


def q_load_stamp(spark, sf_dir):
    """The default load stamp: one value for all rows of a run, within the run's time."""
    now = "select localtimestamp() as t"
    started = spark.sql(now).first()[0]
    rows = materialized(bronze(raw(spark, sf_dir)))
    ended = spark.sql(now).first()[0]
    at = F.col("load_timestamp")
    within = at.between(F.lit(str(started)).cast("timestamp_ntz"), F.lit(str(ended)).cast("timestamp_ntz"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), (F.min(at) == F.max(at)).alias("one_stamp"),
                    F.bool_and(within).alias("within_the_run"))


# --- silver ----------------------------------------------------------------

def q_fct(spark, sf_dir):
    return full(spark, sf_dir)[P.FACT]


def q_pages(spark, sf_dir):
    return full(spark, sf_dir)[P.PAGES]


def q_page_titles(spark, sf_dir):
    return full(spark, sf_dir)[P.PAGES].select("event_uuid", "page_url", "page_title",
                                               "parent_page_title")


def q_devices(spark, sf_dir):
    return full(spark, sf_dir)[P.DEVICES]


# --- gold ------------------------------------------------------------------

def q_all_events(spark, sf_dir):
    return full(spark, sf_dir)[P.ALL_EVENTS]


def q_session_journey(spark, sf_dir):
    return full(spark, sf_dir)[P.JOURNEY]


def _windowed(spark, sf_dir):
    t = full(spark, sf_dir)
    return gold.with_session_windows(gold.enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES]), t[P.FACT])


def q_event_duration(spark, sf_dir):
    return _windowed(spark, sf_dir).select("event_uuid", "session_id", "event_time",
                                           "next_event_time", gold.event_duration())


def q_previous_event(spark, sf_dir):
    return _windowed(spark, sf_dir).select("event_uuid", "session_id", "previous_event_type",
                                           "previous_page_url")


def q_event_counter(spark, sf_dir):
    return full(spark, sf_dir)[P.ALL_EVENTS].select("event_uuid", "session_id", "event_counter")


def q_repeat_click_flags(spark, sf_dir):
    return full(spark, sf_dir)[P.ALL_EVENTS].select("event_uuid", "previous_event_repeated",
                                                    "click_error")


def q_session_page_path(spark, sf_dir):
    t = full(spark, sf_dir)
    return gold.page_view_counts(t[P.FACT], t[P.PAGES])


# --- increments ------------------------------------------------------------

def q_fct_incr(spark, sf_dir):
    return two_batch(spark, sf_dir)["silver_appends"][P.FACT]


def q_pages_incr(spark, sf_dir):
    return two_batch(spark, sf_dir)["silver_appends"][P.PAGES]


def q_pages_incr_empty_target(spark, sf_dir):
    tb = two_batch(spark, sf_dir)
    empty = tb["first"][P.PAGES].where(F.lit(False))
    return silver.pages_increment(tb["after"][P.BASE], empty, LOAD_TS_2)


def q_devices_merge(spark, sf_dir):
    return two_batch(spark, sf_dir)["silver_appends"][P.DEVICES]


def q_devices_merge_stats(spark, sf_dir):
    tb = two_batch(spark, sf_dir)
    src = silver.latest_devices(tb["after"][P.BASE], LOAD_TS_2)
    return merge.merge_stats(tb["first"][P.DEVICES], src)


def q_all_events_incr(spark, sf_dir):
    return two_batch(spark, sf_dir)["gold_appends"][P.ALL_EVENTS]


def q_all_events_incr_unpruned(spark, sf_dir):
    return two_batch(spark, sf_dir, prune=False)["gold_appends"][P.ALL_EVENTS]


def q_session_journey_incr(spark, sf_dir):
    return two_batch(spark, sf_dir)["gold_appends"][P.JOURNEY]


def q_two_batch_silver(spark, sf_dir):
    return two_batch(spark, sf_dir)["after"][P.FACT]


def q_two_batch_pages(spark, sf_dir):
    return two_batch(spark, sf_dir)["after"][P.PAGES]


def q_two_batch_gold(spark, sf_dir):
    return two_batch(spark, sf_dir)["after"][P.ALL_EVENTS]


def q_two_batch_journey(spark, sf_dir):
    return two_batch(spark, sf_dir)["after"][P.JOURNEY]


def q_high_water_marks(spark, sf_dir):
    t1 = two_batch(spark, sf_dir)["first"]
    return marks.high_water_marks({k: t1[k] for k in (P.FACT, P.PAGES, P.ALL_EVENTS, P.JOURNEY)})


def q_late_rows(spark, sf_dir):
    tb = two_batch(spark, sf_dir, late=True)
    late = marks.late_rows(tb["after"][P.BASE], tb["after"][P.FACT])
    return late.select("event_uuid", "session_id", "event_time", "extract_timestamp")


# --- the stored pipeline ---------------------------------------------------

def stored_run(spark, sf_dir, late: bool = False) -> str:
    """The pipeline on storage: two deliveries of files, ``initial_build``
    after the first and ``run_increment`` after the second. Returns the root."""
    root = scratch_path(spark, "stored")
    landing = f"{root}/landing"
    lines = raw_json_lines(*tables(spark, sf_dir))
    first = first_delivery(F.col("filename"), late)
    write_json_lines(lines.where(first), landing, mode="append")
    refresh.initial_build(spark, root, landing, LOAD_TS_1)
    write_json_lines(lines.where(~first), landing, mode="append")
    refresh.run_increment(spark, root, landing, LOAD_TS_2)
    return root


def _stored(name: str):
    def query(spark, sf_dir):
        return store.read_table(spark, stored_run(spark, sf_dir), name) \
            .select(S.TABLE_COLUMNS[name])

    return query


def q_stored_late_rows(spark, sf_dir):
    late = refresh.late_report(spark, stored_run(spark, sf_dir, late=True))
    return late.select("event_uuid", "session_id", "event_time", "extract_timestamp")


def q_stored_order(spark, sf_dir):
    """The order of rows inside the stored files, by their place in the file: per table its
    rows, and whether each file is sorted by the table's write order."""
    root = stored_run(spark, sf_dir)
    out = None
    for name in (P.FACT, P.PAGES, P.DEVICES, P.ALL_EVENTS, P.JOURNEY):
        key = F.struct(*store.WRITE_ORDER[name])
        in_file = Window.partitionBy("file").orderBy("place")
        rows = store.read_table(spark, root, name).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"),
            key.alias("key"))
        before = F.lag("key").over(in_file)
        one = rows.select((before.isNull() | (before <= F.col("key"))).alias("sorted")).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.bool_and("sorted"), F.lit(True)).alias("in_order"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "raw_load": q_raw_load,
    "stream_ingest": q_stream_ingest,
    "stream_raw_to_base": q_stream_raw_to_base,
    "load_audit": q_load_audit,
    "stage_listing": q_stage_listing,
    "stream_base_to_fact": q_stream_base_to_fact,
    "bronze_extract": q_bronze_extract,
    "extract_timestamp": q_extract_timestamp,
    "event_type_clean": q_event_type_clean,
    "bronze": q_bronze,
    "load_stamp": q_load_stamp,
    "fct": q_fct,
    "pages": q_pages,
    "page_titles": q_page_titles,
    "devices": q_devices,
    "all_events": q_all_events,
    "session_journey": q_session_journey,
    "event_duration": q_event_duration,
    "previous_event": q_previous_event,
    "event_counter": q_event_counter,
    "repeat_click_flags": q_repeat_click_flags,
    "session_page_path": q_session_page_path,
    "fct_incr": q_fct_incr,
    "pages_incr": q_pages_incr,
    "pages_incr_empty_target": q_pages_incr_empty_target,
    "devices_merge": q_devices_merge,
    "devices_merge_stats": q_devices_merge_stats,
    "all_events_incr": q_all_events_incr,
    "all_events_incr_unpruned": q_all_events_incr_unpruned,
    "session_journey_incr": q_session_journey_incr,
    "two_batch_silver": q_two_batch_silver,
    "two_batch_pages": q_two_batch_pages,
    "two_batch_gold": q_two_batch_gold,
    "two_batch_journey": q_two_batch_journey,
    "high_water_marks": q_high_water_marks,
    "late_rows": q_late_rows,
    "stored_fact": _stored(P.FACT),
    "stored_devices": _stored(P.DEVICES),
    "stored_all_events": _stored(P.ALL_EVENTS),
    "stored_session_journey": _stored(P.JOURNEY),
    "stored_late_rows": q_stored_late_rows,
    "stored_order": q_stored_order,
}

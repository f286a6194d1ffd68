"""Per-session ordered window values that survive a hot session.

The values are those of ``LEAD/LAG/ROW_NUMBER() OVER (PARTITION BY
session_id ORDER BY event_time NULLS LAST, event_uuid)``. Spark evaluates a
window partition in one task, so a session holding a large share of all rows
(a catch-all or NULL session) would be sorted and scanned by a single task.

Plan:

1. Count rows per session (partial aggregation, so hot keys cost nothing
   extra). Sessions above ``max_rows`` are *hot*; there are at most
   ``total / max_rows`` of them.
2. Without hot sessions: one plain window (one shuffle, one sort).
3. With hot sessions: rows of the others take the plain window. Rows of hot
   sessions are range-partitioned by (session, window order) into parts of
   about half of ``max_rows`` and written to the shared folder; the part's
   number is the chunk. Chunks follow the window order whatever the times
   look like (bursts, equal or NULL times), and the stored rows fix them. The
   window runs per (session, chunk). A small table with one row per chunk --
   its row count, first row and last row -- then gives each chunk its
   row-number offset, the last row of the previous chunk (for LAG) and the
   first row of the next (for LEAD). The values equal the plain window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.session import scratch_path

DEFAULT_MAX_ROWS = 2_000_000
MAX_ROWS_CONF = "spark.clickmart.session.maxRowsPerTask"


def _order() -> list[Column]:
    """Order of events inside a session: by time with NULL times last, ties
    broken by ``event_uuid`` so every window sees the same total order."""
    return [F.asc_nulls_last("event_time"), F.asc_nulls_last("event_uuid")]


def session_key() -> Column:
    # Equal for equal sessions, NULL included, and never NULL itself.
    sid = F.col("session_id")
    return F.concat(F.when(sid.isNull(), F.lit("0")).otherwise(F.lit("1")),
                    F.coalesce(sid, F.lit("")))


def _plain(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("session_id").orderBy(*_order())
    return df.select(
        "*",
        F.lead("event_time").over(w).alias("next_event_time"),
        F.lag("event_type").over(w).alias("previous_event_type"),
        F.lag("page_url").over(w).alias("previous_page_url"),
        F.row_number().over(w).cast("long").alias("event_counter"),
    )


def hot_sessions(keys: DataFrame, max_rows: int) -> DataFrame:
    """Sessions with more than ``max_rows`` rows, with their row count."""
    sizes = keys.groupBy(session_key().alias("_hsk")).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.where(F.col("_n") > F.lit(max_rows))


def configured_max_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))


def with_session_windows(df: DataFrame, keys: DataFrame | None = None,
                         max_rows: int | None = None) -> DataFrame:
    """``df`` plus ``next_event_time``, ``previous_event_type``,
    ``previous_page_url`` and ``event_counter``.

    ``keys`` (``session_id``; default ``df``) is only used to size sessions --
    pass the un-joined fact to avoid evaluating joins twice. Checking for hot
    sessions runs one aggregation job.
    """
    hot, n_hot_rows = find_hot(keys if keys is not None else df, max_rows)
    if n_hot_rows == 0:
        return _plain(df)
    if max_rows is None:
        max_rows = configured_max_rows(df)
    rest, chunked = split_hot(df, hot, n_hot_rows, max_rows)
    return _plain(rest).unionByName(_chunked(chunked, df.columns))


def find_hot(keys: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, int]:
    """The hot sessions (stored, so that their size is known to the planner)
    and how many rows they have; runs one aggregation job."""
    if max_rows is None:
        max_rows = configured_max_rows(keys)
    path = scratch_path(keys.sparkSession, "hotsessions")
    hot = hot_sessions(keys.select("session_id"), max_rows)
    hot.write.parquet(path)
    stored = keys.sparkSession.read.schema(hot.schema).parquet(path)
    return stored, stored.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]


def split_hot(df: DataFrame, hot: DataFrame, n_hot_rows: int,
              max_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary sessions, and stored rows of hot ones with ``_sk``
    (null-safe session key) and ``_chunk``. A chunk has about ``max_rows / 2``
    rows; only rows equal in time, uuid, type and page stay together."""
    x = df.withColumn("_sk", session_key())
    is_hot = x["_sk"] == hot["_hsk"]
    n = max(1, -(-2 * n_hot_rows // max_rows))
    tie = [F.xxhash64(*[c for c in ("event_type", "page_url") if c in df.columns])] \
        if "event_type" in df.columns else []
    path = scratch_path(df.sparkSession, "hotrows")
    ranged = (x.join(hot, is_hot, "left_semi")
              .repartitionByRange(n, "_sk", *_order(), *tie)
              .withColumn("_chunk", F.spark_partition_id()))
    ranged.write.parquet(path)
    stored = df.sparkSession.read.schema(ranged.schema).parquet(path)
    return x.join(hot, is_hot, "left_anti").drop("_sk"), stored


def _chunked(x: DataFrame, columns: list[str]) -> DataFrame:
    w = Window.partitionBy("_sk", "_chunk").orderBy(*_order())
    local = x.select(
        "*",
        F.lead("event_time").over(w).alias("_lead_t"),
        F.lag("event_type").over(w).alias("_lag_type"),
        F.lag("page_url").over(w).alias("_lag_url"),
        F.row_number().over(w).cast("long").alias("_rn"),
        F.lead(F.lit(1)).over(w).isNull().alias("_is_last"),
    )
    # the edges are the window's own first and last rows
    first, last = F.col("_rn") == 1, F.col("_is_last")
    edges = local.where(first | last).groupBy("_sk", "_chunk").agg(
        F.max("_rn").alias("_cn"),
        F.max(F.when(first, F.struct("event_time"))).alias("_first"),
        F.max(F.when(last, F.struct(F.col("event_type").alias("type"),
                                    F.col("page_url").alias("url")))).alias("_last"),
    )
    we = Window.partitionBy("_sk").orderBy("_chunk")
    before = we.rowsBetween(Window.unboundedPreceding, -1)
    fix = edges.select(
        F.col("_sk").alias("_fsk"), F.col("_chunk").alias("_fchunk"),
        F.coalesce(F.sum("_cn").over(before), F.lit(0)).alias("_offset"),
        F.lag("_last.type").over(we).alias("_prev_type"),
        F.lag("_last.url").over(we).alias("_prev_url"),
        F.lead("_first.event_time").over(we).alias("_next_t"),
        F.lead(F.lit(1)).over(we).isNotNull().alias("_has_next"),
    )
    y = local.join(fix, (local["_sk"] == fix["_fsk"]) & (local["_chunk"] == fix["_fchunk"]))
    return y.select(
        *[F.col(c) for c in columns],
        F.when(last & F.col("_has_next"), F.col("_next_t"))
         .otherwise(F.col("_lead_t")).alias("next_event_time"),
        F.when(first, F.col("_prev_type")).otherwise(F.col("_lag_type"))
         .alias("previous_event_type"),
        F.when(first, F.col("_prev_url")).otherwise(F.col("_lag_url")).alias("previous_page_url"),
        (F.col("_rn") + F.col("_offset")).alias("event_counter"),
    )

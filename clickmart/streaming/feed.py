"""Change feeds: each consumer follows a table at its own pace, exactly once.

``follow`` hands the rows that a stream-written table gained since the
consumer's last batch to a sink keyed by batch id. The consumer's checkpoint is
its offset. A batch is written first and its offset committed after; if the
driver is lost in between, the next call gets the same rows under the same id
and replaces the batch's folder, so nothing is lost or doubled. Consumers do not
know of one another: a new one starts at the table's first row, and a slow one
finds all it has missed.

``read_followed`` reads finished batches only: their folders are found by their
``_SUCCESS`` files in one listing.

``count_files`` follows the raw table with one row per batch and file name, the
state of the landing audit: an audit reads the raw rows (their file names only)
that came since the last one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.sources.raw import load_audit
from clickmart.streaming.ingest import _fs, drained

BATCH = "batch"


def follow(table: DataFrame, sink_dir: str, checkpoint: str,
           step: Callable[[DataFrame], DataFrame],
           written: Callable[[int], None] = lambda batch: None) -> int:
    """Write ``step`` of the new rows of the streaming ``table`` below ``sink_dir``; returns how
    many rows were read. ``step`` gets a plain DataFrame of one batch. ``written`` is
    called between a batch's write and the commit of its offset."""
    def keep(rows: DataFrame, batch: int) -> None:
        step(rows).write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/{BATCH}={batch}")
        written(batch)

    return drained(table.writeStream.foreachBatch(keep)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())


def finished_batches(spark: SparkSession, sink_dir: str) -> list[int]:
    """Ids of the batches below ``sink_dir`` that were written whole."""
    fs, p, _ = _fs(spark, f"{sink_dir.rstrip('/')}/{BATCH}=*/_SUCCESS")
    names = [re.search(rf"{BATCH}=(\d+)$", st.getPath().getParent().toString())
             for st in fs.globStatus(p) or ()]
    return sorted(int(n[1]) for n in names if n)


def read_followed(spark: SparkSession, sink_dir: str, schema: str) -> DataFrame:
    """The rows of all finished batches (columns in DDL); none if there is no batch yet."""
    batches = finished_batches(spark, sink_dir)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(
        *[f"{sink_dir.rstrip('/')}/{BATCH}={b}" for b in batches])


FILE_COUNTS = "filename string, n_rows bigint"


def count_files(spark: SparkSession, raw_dir: str, counts_dir: str, checkpoint: str) -> int:
    """Bring the rows per file up to the raw table's newest batch; returns the rows read."""
    names = spark.readStream.schema(S.RAW_SCHEMA).parquet(raw_dir).select("filename")
    return follow(names, counts_dir, checkpoint, load_audit)


def counted_files(spark: SparkSession, counts_dir: str) -> DataFrame:
    """(filename, n_rows) as of the last ``count_files``; equals ``load_audit`` of those rows."""
    return read_followed(spark, counts_dir, FILE_COUNTS).groupBy("filename").agg(
        F.sum("n_rows").alias("n_rows"))

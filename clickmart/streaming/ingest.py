"""Incremental ingestion with Structured Streaming.

* ``ingest_files``: newline-delimited JSON files -> raw parquet table. The
  file source's log in the checkpoint remembers every file already read, so
  each file is loaded exactly once however often the query runs.
* ``raw_to_base``: raw table -> ``events_base``. The parquet source's offsets
  play the part of a consume-on-read change feed: a run reads only files the
  raw table gained since the previous committed run.

Both run with ``availableNow``: process what is there, then stop -- the shape
of a scheduled refresh. A run that finds nothing new writes nothing.

Starting a query costs seconds even then, so a refresh asks first (``only_if_new``):
a run notes the state of its source as it was before it started -- a fingerprint
of the file listing, the newest batch of the raw table -- and the next run starts
no query while the source is still in that state. A note that is missing, old or
half-written costs one run that finds nothing; it can lose nothing.

With an ``archive`` folder, loaded files are moved there once the batch after
theirs begins, so that a run lists the files that are new or just loaded and not
all that ever landed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart import schemas as S
from clickmart.operators.bronze import bronze
from clickmart.sources.raw import file_path_column


# Far more often than the entries a query keeps (100 by default) can turn over.
POLL_SECONDS = 1
# The file source forgets, and then never loads, files older than this against
# the newest it has seen. Its default of a week would drop backfills and copies
# that keep their times.
MAX_FILE_AGE = "36500d"


def run_available_now(df: DataFrame, path: str, checkpoint: str,
                      partition_by: list[str] | None = None) -> int:
    """Append ``df``'s new input to parquet at ``path`` and stop; returns the
    number of input rows processed by this run."""
    writer = df.writeStream.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return drained(writer
                   .option("path", path)
                   .option("checkpointLocation", checkpoint)
                   .outputMode("append")
                   .trigger(availableNow=True)
                   .start())


def drained(query: StreamingQuery) -> int:
    """Wait for the end of ``query``; the number of input rows that it read. It keeps only its
    latest progress entries, so they are gathered by batch while it runs."""
    rows: dict[int, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(POLL_SECONDS)
        rows.update((p["batchId"], int(p["numInputRows"])) for p in query.recentProgress)
    if query.exception() is not None:  # pragma: no cover - surfaced by Spark
        raise query.exception()
    return sum(rows.values())


def landing_state(spark: SparkSession, source_dir: str) -> str:
    """A fingerprint of the files below ``source_dir``; only their listing is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_dir)
             .select(F.xxhash64("path", "modificationTime", "length").alias("h")))
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n} files {total}"


def sink_state(spark: SparkSession, path: str) -> str:
    """The newest batch that a stream has committed to the table at ``path``."""
    fs, p, jvm = _fs(spark, f"{path}/_spark_metadata")
    if not fs.exists(p):
        return "no batch"
    batches = [re.match(r"(\d+)", st.getPath().getName()) for st in fs.listStatus(p)]
    return f"batch {max((int(m[1]) for m in batches if m), default=-1)}"


def only_if_new(spark: SparkSession, checkpoint: str, state: str, run: Callable[[], int]) -> int:
    """``run()``, unless the source is as the last finished run found it; then 0."""
    fs, p, jvm = _fs(spark, f"{checkpoint.rstrip('/')}.seen")
    if fs.exists(p):
        stream = fs.open(p)
        try:
            if jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") == state:
                return 0
        finally:
            stream.close()
    n = run()
    out = fs.create(p, True)
    try:
        out.write(bytearray(state.encode()))
    finally:
        out.close()
    return n


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def raw_file_stream(spark: SparkSession, source_dir: str,
                    max_files_per_trigger: int | None = None,
                    archive: str | None = None) -> DataFrame:
    reader = (spark.readStream.format("json")
              .option("singleVariantColumn", "json_data")
              .option("recursiveFileLookup", "true")
              .option("maxFileAge", MAX_FILE_AGE)
              .schema("json_data variant"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(source_dir).select("json_data", file_path_column().alias("filename"))


def ingest_files(spark: SparkSession, source_dir: str, raw_dir: str, checkpoint: str,
                 max_files_per_trigger: int | None = None, archive: str | None = None) -> int:
    """Load every JSON file under ``source_dir`` not loaded before."""
    return run_available_now(raw_file_stream(spark, source_dir, max_files_per_trigger, archive),
                             raw_dir, checkpoint)


def start_ingest(spark: SparkSession, source_dir: str, raw_dir: str, checkpoint: str,
                 interval: str = "1 minute", max_files_per_trigger: int | None = None):
    """Continuous form of ``ingest_files``: a query that keeps loading new
    files every ``interval`` (the auto-ingest pipe). Returns the running
    ``StreamingQuery``; stop it with ``.stop()``. It shares the file log with
    ``ingest_files`` when given the same checkpoint."""
    return (raw_file_stream(spark, source_dir, max_files_per_trigger)
            .writeStream.format("parquet")
            .option("path", raw_dir)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(processingTime=interval)
            .start())


def raw_to_base(spark: SparkSession, raw_dir: str, base_dir: str, checkpoint: str,
                load_ts=None, strict: bool = True,
                layout: Callable[[DataFrame], DataFrame] | None = None,
                partition_by: list[str] | None = None) -> int:
    """Append the bronze form of raw rows not yet processed to ``base_dir``
    (``layout`` may add the columns the sink partitions by)."""
    raw = spark.readStream.schema(S.RAW_SCHEMA).parquet(raw_dir)
    out = bronze(raw, load_ts, strict)
    if layout is not None:
        out = layout(out)
    return run_available_now(out, base_dir, checkpoint, partition_by)


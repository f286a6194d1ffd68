"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Slots of the filter bitmaps. A filter broadcasts at most slots / 64 rows of
#: 64 bits, whatever the data.
FILTER_SLOTS = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage; the files survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, cast; further columns of any name are left out."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns.items()])


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with whole record batches in and out."""
    return df.mapInArrow(fn, schema)


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """One object for all tasks of a Python worker process, made on first use.

    Task functions are sent with the job and have no module of their own to
    keep it in.
    """
    held = sys.modules.setdefault("_clickmart_worker", types.ModuleType("_clickmart_worker"))
    kept = held.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that few texts are held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blobs(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; null counts as empty."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def semi_filter(df: DataFrame, keys: DataFrame, names: list[str],
                slots: int = FILTER_SLOTS) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys`` (a superset of the semi-join).

    Keys are hashed to one of ``slots`` bits; the bitmap, in words of 64 bits,
    is what is broadcast, at most ``slots / 64`` rows. It thins out a side
    before a shuffle join, which stays exact.
    """
    def slot(frame: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[frame[n] for n in names]), F.lit(slots))

    hit = keys.select(slot(keys).alias("s")).selectExpr(
        "cast(s div 64 as int) as __word", "cast(s % 64 as int) as b") \
        .groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, b))").alias("__bits"))
    cols = df.columns
    return (df.withColumn("__slot", slot(df)).withColumn("__word", F.expr("cast(__slot div 64 as int)"))
            .join(F.broadcast(hit), "__word")
            .where(F.expr("getbit(__bits, cast(__slot % 64 as int)) = 1"))
            .select(*[df[c] for c in cols]))

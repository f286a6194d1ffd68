"""Which day folders hold a key: Bloom filters by folder, in shards.

A table's run writes one filter per day that it wrote: the day's distinct keys
are hashed, dealt to ``level`` shards (a power of two, so that a shard has at
most ``SHARD_KEYS`` keys), and each shard becomes one row with its bits, about
four bytes per key. ``hits`` asks for the days that may hold any of some keys.
Of a million keys that are not there, fewer than one in a day's filter is
taken for one that is, so that a refresh reads the few days that hold its keys
instead of the keys of all days. Hits are a superset; the join that follows is
exact. NULL keys match nothing and are in no filter.

Keys are asked in arrays of bounded size, joined to the filters by shard: no
task holds all keys or all filters.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S

SHARD_KEYS = 1 << 18
BITS_PER_KEY = 32
PROBES = 16
#: Keys that are asked in one row.
ASKED = 1 << 17


def _places(h: np.ndarray, n_bits: int, probe: int) -> np.ndarray:
    """The place of each hash among ``n_bits`` at one of the probes 1 to ``PROBES``."""
    # mixed anew for each probe: steps of one length would repeat in a small filter
    z = h.astype(np.uint64) + np.uint64(probe * 0x9E3779B97F4A7C15 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) % np.uint64(n_bits)


def _bits(h: np.ndarray) -> tuple[int, bytes]:
    n_bits = max(64, -(-len(h) * BITS_PER_KEY // 64) * 64)
    out = np.zeros(n_bits, np.uint8)
    for i in range(1, PROBES + 1):
        out[_places(h, n_bits, i)] = 1
    return n_bits, np.packbits(out, bitorder="little").tobytes()


def _holds(bits: bytes, n_bits: int, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter; a probe looks only at those that the last one left."""
    table, left = np.frombuffer(bits, np.uint8), np.arange(len(h))
    for i in range(1, PROBES + 1):
        at = _places(h[left], n_bits, i)
        left = left[(table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1) == 1]
        if not len(left):
            break
    return left


def filters(rows: DataFrame, key: Column, day: Column, run: int,
            shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Filter rows of what ``run`` wrote: one or more per day (columns of ``*_keys`` tables)."""
    keys = rows.select(day.alias("day"), F.xxhash64(key).alias("h"), key.isNotNull().alias("is")) \
        .where("is").select("day", "h").distinct()
    sizes = keys.groupBy("day").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("day").alias("s_day"),
        F.expr(f"shiftleft(1L, cast(greatest(0, ceil(log2(n / {shard_keys}))) as int))").alias("level"))
    # one row per day: sent to the keys, which would else be dealt out by a few days
    sharded = keys.join(F.broadcast(sizes), keys["day"].eqNullSafe(sizes["s_day"])).select(
        "day", "level", F.pmod("h", "level").alias("shard"), "h")
    schema = S.TABLE_DDL[S.FACT_KEYS]

    def build(shard: pa.Table) -> pa.Table:
        n_bits, bits = _bits(shard.column("h").to_numpy())
        return pa.table({
            "at_run": pa.array([run], pa.int32()), "day": shard.column("day").slice(0, 1),
            "level": shard.column("level").slice(0, 1), "shard": shard.column("shard").slice(0, 1),
            "n_bits": pa.array([n_bits], pa.int64()), "bits": pa.array([bits], pa.binary())})

    return sharded.groupBy("day", "level", "shard").applyInArrow(build, schema)


def hits(known: DataFrame, keys: DataFrame, key: str, asked: int = ASKED) -> list[tuple[int, date | None]]:
    """(run, day) of each filter of ``known`` that may hold some of ``keys``.

    The list is as long as folders are hit; the keys stay on Spark.
    """
    hashes = keys.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h")).distinct()
    levels, n = known.agg(F.collect_set("level").alias("levels"), hashes.agg(F.count("h")).scalar()) \
        .first()
    if not levels or n == 0:
        return []
    level = F.col("a_level")
    parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(n) / (level * F.lit(asked))))
    arrays = (hashes.withColumn("a_level", F.explode(F.array(*[F.lit(x).cast("long") for x in levels])))
              .withColumn("a_shard", F.pmod("h", "a_level"))
              .groupBy("a_level", "a_shard", F.pmod(F.xxhash64("h"), parts).alias("part"))
              .agg(F.collect_list("h").alias("hashes")))
    joined = known.join(arrays, (known["level"] == arrays["a_level"])
                        & (known["shard"] == arrays["a_shard"])) \
        .select("at_run", "day", "n_bits", "bits", "hashes")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                h = batch.column("hashes")[i].values.to_numpy()
                if len(_holds(batch.column("bits")[i].as_py(), batch.column("n_bits")[i].as_py(), h)):
                    yield batch.slice(i, 1).select(["at_run", "day"])

    found = joined.mapInArrow(probe, "at_run int, day date").distinct()
    return [(r["at_run"], r["day"]) for r in found.collect()]

"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words: a share of all words, dealt by weight; a
target stops at ``cap`` times its source's size and the excess is dealt again
by weight among the others until none is above. A document's expected copies
are its source's target over its size. Within each source the documents stand
in a fixed order, their expected copies are summed up (whole numbers of 2^-24
copies, so sums are exact), one offset is added that is drawn from the seed and
the source's name, and a document is emitted once for each integer that its
stretch of the sum crosses. The order is by size, so that neighbours stand in
for one another: a source's words then miss the target by less than its
longest document. Reruns agree: nothing depends on partitions.

Scale: one pass over the texts, of which only sizes are kept. The sum runs in
two levels over ranges of (source, size, doc_id): the order cuts a source that
holds a third of all rows into as many ranges as any other rows. One row per
source is gathered in one task, to deal the targets; sources are corpora, not
documents.

Defined cases: a null text has size 0; documents of size 0 are sampled like
others, and a source whose documents are all empty has target 0 and gives
none; a null source is a source of its own, after all others; null and
repeated doc_ids are rows of their own, equal rows share copies in any order;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, stored

#: One copy, in the whole numbers that are summed.
BITS = 24
ONE = 1 << BITS
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2),
                   share: Fraction = Fraction(3, 2), cap: int = 2) -> DataFrame:
    """(source, source_size) with ``target``: ``share`` of all sizes dealt by weight.

    Weights repeat along the sources in code-point order, null last. With the
    sources sorted by the level at which they fill up (cap over weight), the
    common level is the first that the sources from there on can hold.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy(F.col("_full"), F.col("_rank"))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limit = F.col("source_size") * F.lit(cap)
    w = F.array(*[F.lit(int(x)).cast("long") for x in weights])
    dealt = (
        sizes.withColumn("_rank", F.row_number().over(by_name))
        .withColumn("_w", F.get(w, (F.col("_rank") - 1) % len(weights)))
        .withColumn("_full", limit / F.col("_w"))
        # whole numbers, in parts of 1 / share.denominator word
        .withColumn("_left", F.sum("source_size").over(every) * F.lit(share.numerator)
                    - F.coalesce(F.sum(limit).over(before), F.lit(0)) * F.lit(share.denominator))
        .withColumn("_level", F.col("_left").cast("double")
                    / (F.sum("_w").over(after) * F.lit(share.denominator)).cast("double"))
        .withColumn("_holds", F.col("_level") <= F.col("_full"))
        .withColumn("_capped", ~F.coalesce(F.max("_holds").over(
            level.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(False)))
        .withColumn("_common", F.max(F.when(F.col("_holds"), F.struct(
            -F.col("_full"), -F.col("_rank"), F.col("_level").alias("level")))).over(every))
    )
    return dealt.select(
        "source", "source_size",
        F.when(F.col("_capped"), limit.cast("double"))
        .otherwise(F.least(limit.cast("double"), F.col("_w") * F.col("_common.level")))
        .alias("target"))


def offset(seed: str) -> Column:
    """A whole number under ``ONE`` from the seed and the source's name."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def copies(docs: DataFrame, seed: str = "mix", **deal) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, copies, taken.

    ``deal``: arguments of ``source_targets``.
    """
    rows = only(docs, doc_id="long", source="string", text="string")
    sized = stored(rows.select("doc_id", "source", F.xxhash64("text").alias("text_hash"),
                               words(F.col("text")).alias("size")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(
        source_targets(sizes, **deal)
        .withColumn("_expected", F.when(F.col("source_size") > 0, F.floor(
            F.col("target") / F.col("source_size") * F.lit(ONE) + F.lit(0.5)))
            .otherwise(F.lit(0)).cast("long"))
        .withColumn("_offset", offset(seed))
        .withColumnRenamed("source", "_source"), "targets")
    order = ["size", "doc_id", "text_hash"]
    ranged = stored(
        sized.join(targets, sized["source"].eqNullSafe(targets["_source"])).drop("_source")
        .repartitionByRange("source", *order).withColumn("_part", F.spark_partition_id()), "ranges")

    sums = ranged.groupBy("source", "_part").agg(F.sum("_expected").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_source"), F.col("_part").alias("_at"),
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    here = Window.partitionBy("source", "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_end", F.sum("_expected").over(here))
    placed = placed.join(starts, (placed["_part"] == starts["_at"])
                         & placed["source"].eqNullSafe(starts["_source"]))
    end = F.col("_start") + F.col("_end") + F.col("_offset")
    crossed = F.shiftright(end, BITS) - F.shiftright(end - F.col("_expected"), BITS)
    return (placed.withColumn("copies", crossed)
            .select("doc_id", "source", "text_hash", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: str = "mix", **deal) -> DataFrame:
    """The mixed corpus: rows of ``docs`` as often as they were drawn, numbered in ``copy`` from 1.

    Copies come back to their rows by (doc_id, source, text hash). Rows equal in
    all three are numbered among themselves; only those are moved for it.
    """
    drawn = copies(docs, seed, **deal).groupBy("doc_id", "source", "text_hash").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("copies").alias("_c")).where("_c > 0") \
        .select(F.col("doc_id").alias("_doc"), F.col("source").alias("_source"),
                F.col("text_hash").alias("_hash"), "_n", "_c")
    names = docs.columns
    rows = docs.withColumn("_key", F.xxhash64(docs["text"].cast("string")))
    met = rows.join(drawn, (rows["_key"] == drawn["_hash"])
                    & rows["doc_id"].cast("long").eqNullSafe(drawn["_doc"])
                    & rows["source"].cast("string").eqNullSafe(drawn["_source"]))
    one = met.where("_n = 1").withColumn("_mine", F.col("_c"))
    nth = F.row_number().over(Window.partitionBy("_doc", "_source", "_hash").orderBy("_hash"))
    many = met.where("_n > 1").withColumn("_nth", nth).withColumn(
        "_mine", F.expr("_c div _n + if(_nth <= _c % _n, 1, 0)")).drop("_nth").where("_mine > 0")
    return one.unionByName(many).select(
        *[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mine")))
        .alias("copy"))

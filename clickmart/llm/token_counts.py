"""Token counts: an exact histogram of document lengths and its suffix sums.

Documents are encoded whole and counted by encoded length. For every context
limit that occurs as a length, suffix sums over the histogram give what a
packer asks: how many documents are longer, the tokens in all, the tokens left
when every document is cut at the limit, and the share of documents that fit.
``at_limit`` answers any other limit from the same table.

Defined cases: a null or empty text has length 0; equal rows count each;
other columns are not read; an empty table gives no rows. Hot keys: lengths
are pre-aggregated before the shuffle, so a common length costs one row per
task; suffix sums run per block of lengths, and only block totals (at most
longest length / ``BLOCK``) meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blobs, map_batches, only
from .word_encoder import word_encoder

#: Lengths in a block of the two-level suffix sums.
BLOCK = 1024


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens) of each whole text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array(encoder.count(blobs(batch)), pa.int64())],
                ["doc_id", "n_tokens"])

    return map_batches(only(docs, doc_id="long", text="string"), rows,
                       "doc_id long, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens, n_docs) from (n_tokens)."""
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length as a limit: totals, documents over it, tokens after cutting, quantile.

    Columns: context_limit, n_docs (of that length), docs_over, tokens_over
    (of the documents over it), total_docs, total_tokens, truncated_tokens
    (sum of min(length, limit)), fitting_share (quantile of the limit).
    """
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    up = Window.orderBy(F.col("block").desc())
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        "block", (F.sum("d").over(up) - F.col("d")).alias("d_after"),
        (F.sum("t").over(up) - F.col("t")).alias("t_after"),
        F.sum("d").over(Window.partitionBy()).alias("total_docs"),
        F.sum("t").over(Window.partitionBy()).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    over = F.sum("n_docs").over(within) - F.col("n_docs") + F.col("d_after")
    tokens_over = F.sum("tokens").over(within) - F.col("tokens") + F.col("t_after")
    got = h.join(blocks, "block").select(
        F.col("n_tokens").alias("context_limit"), "n_docs", over.alias("docs_over"),
        tokens_over.alias("tokens_over"), "total_docs", "total_tokens")
    cut = F.col("total_tokens") - F.col("tokens_over") \
        + F.col("docs_over") * F.col("context_limit")
    return got.select("*", cut.alias("truncated_tokens"),
                      ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs"))
                      .alias("fitting_share"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """The answers for one limit: those of the longest length up to it.

    One row: context_limit, docs_over, total_tokens, truncated_tokens; of an
    empty table no row. A limit below every length cuts all documents.
    """
    fits = F.when(F.col("context_limit") <= limit, F.col("context_limit"))
    got = sums.agg(F.max("total_docs").alias("n"), F.max("total_tokens").alias("t"),
                   F.max_by(F.struct("docs_over", "tokens_over"), fits).alias("s"))
    over = F.coalesce("s.docs_over", "n")
    return got.where("n is not null").select(
        F.lit(limit).alias("context_limit"), over.alias("docs_over"),
        F.col("t").alias("total_tokens"),
        (F.col("t") - F.coalesce("s.tokens_over", "t") + over * limit).alias("truncated_tokens"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """(context_limit): the shortest length that at least ``share`` of the documents fit."""
    return sums.where(F.col("fitting_share") >= share).agg(
        F.min("context_limit").alias("context_limit"))

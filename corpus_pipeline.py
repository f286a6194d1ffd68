"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows it keeps. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import (decontamination, ngram_join, quality_rules, secret_scan,
                           sentence_pieces)
from clickmart.llm.common import stored, table
from clickmart.llm.queries import PIECE_MODEL, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return ngram_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs, secret_scan.train(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of the whole texts, little-endian uint32."""
    ids = sentence_pieces.encode(docs, tokenizer_path(PIECE_MODEL))
    return ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", good_quality), ("n-gram jaccard join", without_near_duplicates),
          ("benchmark decontamination", uncontaminated), ("secret scans", without_secrets),
          ("sentencepiece encoding", encoded)]

#: Compression ratios, the network and the encoder are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: each document that was kept, as ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

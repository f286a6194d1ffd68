"""The raw layer: one semi-structured value per JSON line plus its file name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S


def empty_raw(spark: SparkSession) -> DataFrame:
    """The raw table before any load: ``json_data variant, filename string``."""
    return spark.createDataFrame([], S.RAW_SCHEMA)


def decoded_path(uri: Column) -> Column:
    """A file URI percent-decoded (``#`` arrives as ``%23``); ``+`` is kept
    as is rather than read as a blank. A URI without ``%`` is its own path, which spares most
    rows the decoding."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), decoded).otherwise(uri)


def file_path_column() -> Column:
    """Full path of the file a row came from."""
    return decoded_path(F.col("_metadata.file_path"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of newline-delimited JSON files below ``path`` (one object
    per line, no outer array) into the raw layout. Used for the one-shot
    bulk load; the streaming reader loads each file once instead."""
    return (
        spark.read.format("json")
        .option("singleVariantColumn", "json_data")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("json_data", file_path_column().alias("filename"))
    )


def load_audit(raw: DataFrame) -> DataFrame:
    """Distinct file names in the raw layer with their row counts, to compare
    against a listing of the bucket."""
    return raw.groupBy("filename").agg(F.count(F.lit(1)).alias("n_rows"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` as a distributed listing (``filename``,
    ``size``): only metadata is read, never file contents."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select(decoded_path(F.col("path")).alias("filename"), F.col("length").alias("size")))


def archived_files(spark: SparkSession, archive: str) -> DataFrame:
    """The files of an archive folder, under the names they had where they landed: the
    archive repeats their whole path below itself."""
    base = spark.createDataFrame([(archive,)], "p string").select(
        F.regexp_replace("p", "^[a-z0-9]+:/*", "/")).first()[0].rstrip("/")
    name = F.col("filename")
    scheme = F.regexp_extract(name, "^([a-z0-9]+:/*)/", 1)
    return list_files(spark, archive).withColumn("filename", F.concat(
        scheme, F.substring_index(name, base, -1)))


def listing_audit(raw: DataFrame, listing: DataFrame) -> DataFrame:
    """Every listed file and every loaded file name, with the rows loaded
    from it: ``listed`` false means rows from a file no longer in the
    bucket, ``n_rows`` 0 a listed file that was never loaded."""
    return audit_of(load_audit(raw), listing)


def audit_of(loaded: DataFrame, listing: DataFrame) -> DataFrame:
    """``listing_audit`` from rows per file (``filename``, ``n_rows``)."""
    listed = listing.select("filename", F.lit(True).alias("listed"))
    return (listed.join(loaded, "filename", "full_outer")
            .select("filename", F.coalesce(F.col("listed"), F.lit(False)).alias("listed"),
                    F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows")))

"""What loading and key filters read and do per event, on rows of their own."""

import datetime as dt
import re

import numpy as np
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.timefn import file_hour
from clickmart.operators import keyfilter
from clickmart.operators.bronze import bronze
from clickmart.session import scratch_path
from clickmart.sources.raw import decoded_path
from tests.conftest import event, raw_df

TS = "2026-01-01 00:00:00"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_reads_the_fields_of_raw_and_no_whole_variant(spark):
    path = scratch_path(spark, "test-raw")
    raw_df(spark, [(event("a", "s1", "2024-01-01 03:04:05", url="https://e.com/x"),
                    "data/0_2024-01-01_3#0.json"),
                   (event("b", "s1", "2024-01-01 03:04:06"), "data/nohour.json")]).write.parquet(path)
    out = bronze(spark.read.schema(S.RAW_SCHEMA).parquet(path), TS)
    read = re.search(r"ReadSchema: (.*)", _plan(out))[1]
    assert "variant" not in read, read
    assert {(r.event_uuid, r.page_url, r.extract_timestamp) for r in out.collect()} == {
        ("a", "https://e.com/x", dt.datetime(2024, 1, 1, 3)), ("b", None, None)}


def test_file_hour_takes_the_first_token(spark):
    names = ["x/2024-01-01_3/2025-02-02_4.json", "2024-01-01_13", "2024-01-01_", "", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(file_hour(F.col("f"))).collect()] == [
        dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 13), None, None, None]


def test_decoded_path_with_and_without_percent(spark):
    uris = ["file:///a/b+c.txt", "file:///a/b%23c+d%2Be.txt", "file:///é", "", None]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    assert [r[0] for r in df.select(decoded_path(F.col("u"))).collect()] == [
        "file:///a/b+c.txt", "file:///a/b#c+d+e.txt", "file:///é", "", None]


def test_a_probe_looks_only_at_keys_still_in_question(monkeypatch):
    rng = np.random.default_rng(1)
    held, others = (rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000) for _ in range(2))
    n_bits, bits = keyfilter._bits(held)
    asked, places = [], keyfilter._places
    monkeypatch.setattr(keyfilter, "_places", lambda h, n, probe: asked.append(len(h)) or places(h, n, probe))
    assert len(keyfilter._holds(bits, n_bits, held)) == len(held)
    asked.clear()
    assert len(keyfilter._holds(bits, n_bits, others)) <= 1
    assert sum(asked) < 3 * len(others)


def test_filters_do_not_deal_keys_out_by_day(spark):
    rows = spark.range(1000).select(F.concat(F.lit("e"), "id").alias("k"),
                                    F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("d"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(keyfilter.filters(rows, F.col("k"), F.col("d"), 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

"""Plan properties that matter at scale, read from the physical plans."""

import re

import pytest

import __spark_entry__ as E
from clickmart.operators import silver
from clickmart.plans import pipeline as P
from clickmart.plans import queries as Q
from clickmart.plans import refresh as R
from clickmart.plans import store
from clickmart.session import scratch_path

SF = "/root/testdata/sf0.001"
FILE_QUERIES = {"raw_load", "stream_ingest", "stream_raw_to_base", "stage_listing",
                "stream_base_to_fact"} | {
    k for k in Q.QUERIES if k.startswith("stored_")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(Q.QUERIES) - FILE_QUERIES))
def test_no_cross_joins_or_python_in_plans(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_path(spark, "test-plans")
    landing = f"{root}/landing"
    Q._write_delivery(spark, SF, landing, 1)
    R.initial_build(spark, root, landing, Q.LOAD_TS_1)
    return root


def test_increment_prunes_days_with_the_runtime_mark(spark, stored):
    base = store.read_table(spark, stored, P.BASE)
    fct = store.mark_row(spark, store.summary(spark, stored), P.FACT)
    assert fct.first()[0] == store.read_table(spark, stored, P.FACT).agg({"extract_timestamp": "max"}).first()[0]
    plan = _plan(silver.fact_increment(base, fct, Q.LOAD_TS_2))
    assert re.search(r"PartitionFilters: \[[^\n]*extract_date[^\n]*Subquery", plan)


def test_stored_gold_build_has_one_window_shuffle(spark, stored):
    tables = {n: store.read_table(spark, stored, n) for n in (P.FACT, P.PAGES, P.DEVICES)}
    df = P.gold_build(tables)[P.ALL_EVENTS]
    plan = _plan(df)
    assert plan.count("Window [") == 1
    assert plan.count("hashpartitioning(session_id") == 1


def test_strict_and_lenient_extraction(spark):
    from pyspark.errors import PySparkException

    from clickmart.operators.bronze import bronze
    from tests.conftest import event, raw_df

    bad = raw_df(spark, [(event("a", "s1", "not a time"), "data/0_2024-01-01_1#0.json")])
    with pytest.raises(PySparkException, match="VARIANT|CAST|cast|TIMESTAMP"):
        bronze(bad, "2026-01-01 00:00:00").collect()
    row = bronze(bad, "2026-01-01 00:00:00", strict=False).first()
    assert row["event_time"] is None and row["event_uuid"] == "a"
    assert row["extract_timestamp"] is not None


def test_journey_shares_the_session_partitioning(spark, stored):
    from clickmart.operators import gold

    t = {n: store.read_table(spark, stored, n) for n in (P.FACT, P.PAGES, P.DEVICES)}
    plan = _plan(gold.session_journey(t[P.FACT], t[P.PAGES], t[P.DEVICES]))
    # (session, device) pre-aggregation, session repartition, page views:
    # the regrouping and the final join add no shuffle of their own
    assert plan.count("Exchange hashpartitioning") == 3


def test_queries_build_only_their_layers(spark, monkeypatch):
    """A fact query starts no gold work, and increments only what they read."""
    from clickmart.operators import gold

    def never(*_, **__):
        raise AssertionError("gold was built")

    for name in ("all_events", "session_journey", "all_events_increment"):
        monkeypatch.setattr(gold, name, never)
    for key in ("fct", "pages", "devices", "fct_incr", "pages_incr", "devices_merge"):
        assert Q.QUERIES[key](spark, SF).columns


def test_bronze_is_read_back_by_column(spark):
    plan = _plan(Q.QUERIES["fct"](spark, SF))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan)[1]
    assert "event_uuid" in read and "page_url" not in read

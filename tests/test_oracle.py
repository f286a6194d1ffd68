"""Registered queries against their DuckDB SQL on the smallest scale (the
driver runs all of them at sf0.01: scripts/check_oracle.py)."""

import pytest

import __spark_entry__ as E
from clickmart.plans.queries import QUERIES
from tests.oracle import digest, duckdb_views

SF = "/root/testdata/sf0.001"
# the training-data operators have tests of their own (tests/llm)
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1000
    assert df.columns[:3] == ["event_uuid", "session_id", "device_id"]


def test_events_link_to_all_pages(spark):
    """More different pages than the fifty of the smallest scale."""
    got = E.queries()["page_titles"](spark, "/root/testdata/sf0.01")
    assert got.select("page_url").distinct().count() > 50


HOT_KEYS = ["all_events", "session_journey", "session_page_path", "all_events_incr",
            "session_journey_incr"]


@pytest.mark.parametrize("key", HOT_KEYS)
def test_hot_session_path_matches_oracle(spark, con, key):
    """With a tiny per-task limit nearly every session takes the chunked
    (hot-session) path; results must not change."""
    from clickmart.operators.sessions import MAX_ROWS_CONF

    spark.conf.set(MAX_ROWS_CONF, "3")
    try:
        df = E.queries()[key](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(ocols, res.fetchall())[0]


SMJ_KEYS = ["all_events", "session_journey", "devices_merge", "late_rows", "all_events_incr"]


@pytest.mark.parametrize("key", SMJ_KEYS)
def test_shuffle_join_plans_match_oracle(spark, con, key):
    """Broadcast off: the sort-merge plans a cluster uses for large tables
    (including the NULL-key spreading joins) give the same results."""
    confs = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for c in confs:
        spark.conf.set(c, "-1")
    try:
        df = E.queries()[key](spark, SF)
        rows = [tuple(r) for r in df.collect()]
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for c in confs:
            spark.conf.unset(c)
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(ocols, res.fetchall())[0]

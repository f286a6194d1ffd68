"""The chunked (hot-session) window path equals the plain window."""

import pytest
from pyspark.sql import functions as F

from clickmart.operators import sessions
from clickmart.operators.gold import enrich, page_view_counts
from clickmart.plans import pipeline as P
from clickmart.plans import queries as Q
from tests.conftest import event, raw_df

COLS = ["event_uuid", "next_event_time", "previous_event_type", "previous_page_url", "event_counter"]


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(COLS).collect())


def _enriched(spark, rows):
    t = P.full_build(raw_df(spark, rows), "2026-01-01 00:00:00")
    return enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES])


def test_chunked_equals_plain_on_driver_tables(spark):
    t = Q.full(spark, "/root/testdata/sf0.001")
    e = enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES])
    plain = _rows(sessions._plain(e))
    hot, n = sessions.find_hot(e, 5)
    assert hot.count() > 10 and n > 50
    assert _rows(sessions.with_session_windows(e, max_rows=5)) == plain
    # the same through shuffle joins
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _rows(sessions.with_session_windows(e, t[P.FACT], max_rows=5)) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chunked_with_null_session_null_times_and_duplicates(spark):
    f = "data/0_2024-01-01_1#0.json"
    rows = []
    for i in range(40):
        t = None if i % 7 == 0 else f"2024-01-01 01:{i % 60:02d}:{(i * 13) % 60:02d}"
        rows.append((event(f"u{i:03d}", None if i % 2 else "s1", t,
                           "[Amplitude] Page Viewed" if i % 3 else "[Amplitude] Element Clicked",
                           url=f"https://ex.com/{i % 4}"), f))
    rows.append(rows[5])  # an event delivered twice
    e = _enriched(spark, rows)
    plain = _rows(sessions._plain(e))
    for max_rows in (1, 3, 8):
        assert _rows(sessions.with_session_windows(e, max_rows=max_rows)) == plain, max_rows


def test_null_uuid_tied_on_time_at_a_chunk_edge(spark):
    """A NULL uuid sorts last among rows of one time, in the chunks' edges too."""
    f = "data/0_2024-01-01_1#0.json"
    rows = [(event(None if i == 5 else f"u{i}", "s1", f"2024-01-01 01:00:0{min(i, 4)}",
                   f"type{i}", url=f"https://ex.com/p{i}"), f) for i in range(10)]
    e = _enriched(spark, rows).withColumn(  # a NULL uuid has no page row of its own
        "page_url", F.concat(F.lit("p"), F.col("event_type")))
    plain = _rows(sessions._plain(e))
    for max_rows in range(1, 9):
        assert _rows(sessions.with_session_windows(e, max_rows=max_rows)) == plain, max_rows


@pytest.mark.parametrize("times", ["burst", "null", "equal"])
def test_chunks_are_bounded_whatever_the_times(spark, times):
    """One row a year early and the rest in a burst, or no or equal times."""
    t = {"burst": "if(id = 0, timestamp_ntz'2023-01-01 00:00:00', "
                  "timestampadd(SECOND, id div 100, timestamp_ntz'2024-01-01 00:00:00'))",
         "null": "cast(null as timestamp_ntz)",
         "equal": "timestamp_ntz'2024-01-01 00:00:00'"}[times]
    df = spark.range(20_000).selectExpr(
        "'s' as session_id", f"{t} as event_time", "lpad(cast(id as string), 8, '0') as event_uuid",
        "'a' as event_type", "'p' as page_url")
    hot, n = sessions.find_hot(df, 1000)
    assert n == 20_000
    rest, chunked = sessions.split_hot(df, hot, n, 1000)
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert rest.count() == 0 and sum(sizes) == 20_000
    assert max(sizes) <= 2 * 1000
    got = sessions.with_session_windows(df, max_rows=1000)
    assert got.schema["event_counter"].dataType.simpleString() == "bigint"
    assert _rows(got) == _rows(sessions._plain(df))


def test_no_hot_sessions_plans_one_window(spark):
    t = Q.full(spark, "/root/testdata/sf0.001")
    e = enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES])
    out = sessions.with_session_windows(e, max_rows=10_000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    assert "_chunk" not in plan


def test_hot_rows_are_joined_once(spark):
    """The hot plan reads stored rows; only ordinary sessions' joins are left in it."""
    t = Q.full(spark, "/root/testdata/sf0.001")
    e = enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES])
    out = sessions.with_session_windows(e, max_rows=5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2


def test_page_path_two_level_equals_plain(spark):
    t = Q.full(spark, "/root/testdata/sf0.001")
    plain = page_view_counts(t[P.FACT], t[P.PAGES], max_rows=10_000)
    for max_rows in (1, 2, 4):
        chunked = page_view_counts(t[P.FACT], t[P.PAGES], max_rows=max_rows)
        got = sorted(tuple(str(v) for v in r) for r in chunked.collect())
        want = sorted(tuple(str(v) for v in r) for r in plain.collect())
        assert got == want, max_rows

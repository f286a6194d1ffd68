
import datetime as dt

from pyspark.sql import functions as F

from clickmart.operators import gold, merge, silver
from clickmart.operators.bronze import bronze
from clickmart.plans import pipeline as P
from tests.conftest import event, raw_df

F1 = "data/0_2024-01-01_1#0.json"
F2 = "data/0_2024-01-01_2#0.json"
LOAD = "2026-01-01 00:00:00"


def test_event_twice_gives_four_rows(spark):
    e = event("u1", "s1", "2024-01-01 01:00:00", url="https://ex.com/a")
    t = P.full_build(raw_df(spark, [(e, F1), (e, F1)]), LOAD)
    assert t[P.ALL_EVENTS].count() == 4


def test_ties_ordered_by_uuid(spark):
    rows = [(event(u, "s1", "2024-01-01 01:00:00", url="https://ex.com/" + u), F1) for u in ("b", "a", "c")]
    t = P.full_build(raw_df(spark, rows), LOAD)
    got = {r["event_uuid"]: r["event_counter"] for r in t[P.ALL_EVENTS].collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    j = t[P.JOURNEY].first()
    assert j["page_path"] == "a, b, c"


def test_null_times_last_and_durations(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:00.9"), F1),
            (event("b", "s1", "2024-01-01 01:00:02.1"), F1),
            (event("c", "s1", None), F1),
            (event("z", "s2", "2024-01-01 01:00:00"), F1)]
    t = P.full_build(raw_df(spark, rows), LOAD)
    ae = {r["event_uuid"]: r for r in t[P.ALL_EVENTS].collect()}
    assert ae["a"]["event_counter"] == 1 and ae["c"]["event_counter"] == 3
    assert float(ae["a"]["event_duration_s"]) == 2.0
    assert ae["b"]["event_duration_s"] is None  # next time is NULL
    assert ae["z"]["event_duration_s"] is None  # single event
    j = {r["session_id"]: r for r in t[P.JOURNEY].collect()}
    assert j["s2"]["event_duration_s"] == 0  # one-event session: 0 here, NULL above


def test_flags_and_null_pages(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", "[Amplitude] Element Clicked", url="https://ex.com/p"), F1),
            (event("b", "s1", "2024-01-01 01:00:02", "[Amplitude] Element Clicked", url="https://ex.com/p"), F1),
            (event("c", "s1", "2024-01-01 01:00:03", "[Amplitude] Page Viewed", url="https://ex.com/p"), F1),
            (event("d", "s1", "2024-01-01 01:00:04", "error_raised"), F1),
            (event("e", "s1", "2024-01-01 01:00:05", "error_raised"), F1)]
    t = P.full_build(raw_df(spark, rows), LOAD)
    ae = {r["event_uuid"]: r for r in t[P.ALL_EVENTS].collect()}
    assert [ae[k]["previous_event_repeated"] for k in "abcde"] == [False, True, False, False, False]
    # click_error looks at the previous type only (the current one is a view)
    assert [ae[k]["click_error"] for k in "abcde"] == [False, True, True, False, False]
    # equal NULL pages are not "the same page"
    assert ae["e"]["previous_event_repeated"] is False


def test_click_error_after_click_on_same_page(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", "[Amplitude] Element Clicked", url="https://ex.com/p"), F1),
            (event("b", "s1", "2024-01-01 01:00:02", "[Amplitude] Page Viewed", url="https://ex.com/p"), F1)]
    ae = {r["event_uuid"]: r for r in P.full_build(raw_df(spark, rows), LOAD)[P.ALL_EVENTS].collect()}
    assert ae["b"]["click_error"] is True and ae["b"]["previous_event_repeated"] is False


def test_journey_drops_sessions_without_views_and_empty_path(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", "purchase"), F1),
            (event("b", "s2", "2024-01-01 01:00:01"), F1),  # view without page row
            (event("c", None, "2024-01-01 01:00:01", url="https://ex.com/q"), F1)]
    j = P.full_build(raw_df(spark, rows), LOAD)[P.JOURNEY].collect()
    assert [(r["session_id"], r["page_path"], r["total_pages_viewed"]) for r in j] == [("s2", "", 1)]


def test_journey_one_row_per_dimension_device(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", device="d1", url="https://ex.com/a"), F1),
            (event("b", "s1", "2024-01-01 01:00:02", device="d2", url="https://ex.com/b"), F1),
            (event("c", "s1", "2024-01-01 01:00:03", device=None), F1)]
    j = P.full_build(raw_df(spark, rows), LOAD)[P.JOURNEY].collect()
    assert sorted((r["device_id"] or "-", r["total_events"], r["page_path"]) for r in j) == [
        ("-", 1, "a, b"), ("d1", 1, "a, b"), ("d2", 1, "a, b")]


def test_latest_device_profile(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", device="d1", os_name="old"), F1),
            (event("b", "s1", "2024-01-01 02:00:01", device="d1", os_name="new"), F2),
            (event("c", "s1", "2024-01-01 02:00:00", device="d1", os_name="tie-earlier"), F2),
            (event("d", "s1", "2024-01-01 01:00:01", device="d9", os_name="nohour"), "data/x.json"),
            (event("e", "s1", "2024-01-01 03:00:01", device="d9", os_name="later"), F2)]
    d = {r["device_id"]: r["os_name"] for r in silver.latest_devices(bronze(raw_df(spark, rows), LOAD)).collect()}
    # latest stamp wins, ties by latest event time; a NULL stamp counts as latest
    assert d == {"d1": "new", "d9": "nohour"}


def _devices(spark, rows):
    schema = "device_id string, device_type string, device_family string, platform string, " \
             "os_version string, os_name string, load_timestamp timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def test_merge_platform_only_and_null_devices(spark):
    t0 = dt.datetime(2026, 1, 1)
    t1 = dt.datetime(2026, 1, 2)
    target = _devices(spark, [("d1", "m", "f", "iOS", "1", "o", t0),
                              ("d2", "m", "f", "iOS", "1", "o", t0),
                              (None, "m", "f", "iOS", "1", "o", t0),
                              ("d4", "m", "f", "iOS", "1", "o", t0)])
    source = _devices(spark, [("d1", "m", "f", "Web", "1", "o", t1),   # platform only
                              ("d2", "m2", "f", "Web", "2", "o", t1),  # real change
                              (None, "m", "f", "iOS", "1", "o", t1),   # NULL never matches
                              ("d3", "m", "f", "Web", "1", "o", t1)])  # new
    out = merge.merge_devices(target, source).collect()
    by = {}
    for r in out:
        by.setdefault(r["device_id"], []).append(tuple(r))
    assert by["d1"] == [("d1", "m", "f", "iOS", "1", "o", t0)]
    assert by["d2"] == [("d2", "m2", "f", "iOS", "2", "o", t0)]
    assert sorted(x[-1] for x in by[None]) == [t0, t1]
    assert by["d3"] == [("d3", "m", "f", "Web", "1", "o", t1)]
    assert by["d4"] == [("d4", "m", "f", "iOS", "1", "o", t0)]
    stats = merge.merge_stats(target, source).first()
    assert (stats["rows_updated"], stats["rows_inserted"]) == (2, 2)


def test_pages_increment_empty_target_inserts_nothing(spark):
    base = bronze(raw_df(spark, [(event("a", "s1", "2024-01-01 01:00:01", url="https://ex.com/a"), F1)]), LOAD)
    empty = silver.pages(base, LOAD).where(F.lit(False))
    assert silver.pages_increment(base, empty, LOAD).count() == 0
    assert silver.fact_increment(base, silver.fact(base, LOAD).where(F.lit(False)), LOAD).count() == 1


def test_page_path_skips_null_titles(spark):
    rows = [(event("a", "s1", "2024-01-01 01:00:01", url="https://ex.com/x/"), F1),
            (event("b", "s1", "2024-01-01 01:00:02", url="https://ex.com/a//"), F1),
            (event("c", "s1", "2024-01-01 01:00:03", url="https://ex.com/x/y"), F1)]
    t = P.full_build(raw_df(spark, rows), LOAD)
    pv = gold.page_view_counts(t[P.FACT], t[P.PAGES]).first()
    assert (pv["page_path"], pv["total_pages_viewed"]) == ("x, y", 3)


def test_null_keys_spread_but_never_match(spark):
    from clickmart.operators.keys import join_spreading_nulls

    left = spark.createDataFrame([("a", "s1"), (None, "s1"), (None, "s2"), ("b", "s2")], "k string, s string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("\u0000x", 3)], "rk string, v int")
    got = sorted(((r["k"], r["v"]) for r in join_spreading_nulls(left, right, "k", "rk", ["s"]).collect()),
                 key=str)
    assert got == sorted([("a", 1), (None, None), (None, None), ("b", None)], key=str)
    anti = join_spreading_nulls(left, right, "k", "rk", ["s"], how="left_anti").collect()
    assert sorted(str(r["k"]) for r in anti) == ["None", "None", "b"]

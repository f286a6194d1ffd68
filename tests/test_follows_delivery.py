"""Refreshes that read what the delivery needs: session state, key filters, summaries, gate."""

import glob
import json
import os
import shutil
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators import keyfilter
from clickmart.plans import pipeline as P
from clickmart.plans import refresh as R
from clickmart.plans import store
from clickmart.session import scratch_path
from clickmart.streaming import ingest
from tests.conftest import event, raw_df

STAMPS = [f"2026-05-{d:02d} 09:00:00" for d in range(14, 30)]
TABLES = (P.BASE, P.FACT, P.PAGES, P.DEVICES, P.ALL_EVENTS, P.JOURNEY)


def at(day, hour, minute=0):
    return f"2024-01-{day:02d} {hour:02d}:{minute:02d}:00"


def file_of(day, hour, part=0):
    return f"2024-01-{day:02d}_{hour}#{part}.json"


def deliver(folder, events):
    """One file per name; returns nothing that Spark has to wait for."""
    by_file = {}
    for e, name in events:
        by_file.setdefault(name, []).append(json.dumps(e))
    os.makedirs(folder, exist_ok=True)
    for name, lines in by_file.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")


URL = "https://ex.com/a/b"
# a catch-all session over all days, the NULL session, ordinary ones
DELIVERIES = [
    [(event("a1", "all", at(1, 1), url=URL), file_of(1, 1)),
     (event("a2", "all", at(2, 1), device="d2", url=URL + "2"), file_of(2, 1)),
     (event("n1", None, at(1, 1), url=URL), file_of(1, 1)),
     (event("s1", "s1", at(1, 1, 5), url=URL), file_of(1, 1)),
     (event("s2", "s1", at(1, 1, 9), etype="[Amplitude] Element Clicked", url=URL), file_of(1, 1)),
     (event("k1", "s3", at(2, 1, 3), url=URL), file_of(2, 1)),
     (event("k2", "s3", at(2, 1, 4)), file_of(2, 1)),
     (event("h1", "s4", at(2, 1), url=URL), "nohour.json")],
    # goes on; a new session; one without a time
    [(event("a3", "all", at(3, 1), url=URL + "2"), file_of(3, 1)),
     (event("s5", "s1", at(3, 1, 2), etype="[Amplitude] Element Clicked", url=URL), file_of(3, 1)),
     (event("t1", "s5", None, url=URL), file_of(3, 1)),
     (event("t2", "s5", at(3, 1, 7), url=URL), file_of(3, 1)),
     (event("n2", None, at(3, 1, 8), url=URL), file_of(3, 1))],
    # out of order: before old rows of its session, and level with one
    [(event("a4", "all", at(1, 9), url=URL), file_of(4, 1)),
     (event("a3", "late-copy", at(3, 1), url=URL + "2"), file_of(4, 1)),
     (event("t3", "s5", at(3, 1, 8), url=URL), file_of(4, 1))],
    # an event of an untouched session comes again: its old row gets a second page row
    [(event("k1", "s3", at(2, 1, 3), url=URL), file_of(5, 1)),
     (event("a5", "all", at(5, 1), url=URL + "2"), file_of(5, 1)),
     (event("x1", "s6", at(2, 1), url=URL), file_of(1, 1, 7))],  # its hour is long loaded
    # and the session whose rows were doubled goes on, as does the one without a time
    [(event("k3", "s3", at(6, 1), url=URL), file_of(6, 1)),
     (event("t4", "s5", at(6, 1), url=URL), file_of(6, 1)),
     (event("n3", None, at(6, 1), url=URL), file_of(6, 1)),
     (event("h2", "s4", at(6, 1), url=URL), file_of(6, 1))],
]


def rows(df, drop=("load_timestamp", "extract_date")):
    cols = [c for c in df.columns if c not in drop]
    return sorted(tuple(str(v) for v in r) for r in df.select(cols).collect())


@pytest.fixture(scope="module")
def replay(spark):
    """(root, landing, what each refresh asked to read) after all deliveries."""
    root = scratch_path(spark, "test-follows").removeprefix("file:")
    landing = f"{root}/landing"
    asked = []
    original = store._from_paths

    def recording(spark_, root_, name, paths):
        asked[-1].extend((name, p) for p in paths)
        return original(spark_, root_, name, paths)

    store._from_paths = recording
    try:
        for n, events in enumerate(DELIVERIES):
            deliver(f"{landing}/d{n}", events)
            asked.append([])
            if n == 0:
                R.initial_build(spark, root, landing, STAMPS[0])
            else:
                assert R.run_increment(spark, root, landing, STAMPS[n])["refreshed"] == 1
    finally:
        store._from_paths = original
    return root, landing, asked


@pytest.fixture(scope="module")
def pure(spark):
    """The same deliveries through the functions, windowed over everything."""
    path = scratch_path(spark, "test-pure")

    def kept(df, name):
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    def base(n):
        raw = raw_df(spark, [(e, f"data/d{n}/{f}") for e, f in DELIVERIES[n]])
        from clickmart.operators.bronze import bronze

        return kept(bronze(raw, STAMPS[n]), f"base{n}")

    tables = P.full_build(raw_df(spark, [(e, f"data/d0/{f}") for e, f in DELIVERIES[0]]), STAMPS[0])
    tables = {n: kept(df, f"0-{n}") for n, df in tables.items()}
    for n in range(1, len(DELIVERIES)):
        tables = P.apply_increment(tables, base(n), STAMPS[n], prune=False)
        tables = {k: kept(df, f"{n}-{k}") for k, df in tables.items()}
    return tables


@pytest.mark.parametrize("name", TABLES)
def test_equals_windows_over_everything(spark, replay, pure, name):
    got, want = store.read_table(spark, replay[0], name), pure[name]
    if name == P.ALL_EVENTS:
        # the rows of an event that came twice are level in the window order: which of
        # them is first is open
        open_ = ["event_counter", "event_duration_s", "previous_event_repeated", "click_error"]
        got, want = (df.withColumns({c: F.when(F.col("event_uuid") != "k1", F.col(c)) for c in open_})
                     for df in (got, want))
        assert {r["event_counter"] for r in got.where("event_uuid = 'k3'").collect()} == {6}
    assert rows(got) == rows(want)


def test_state_stands_for_all_rows(spark, replay):
    """The newest state of each session against its rows of the whole fact."""
    root = replay[0]
    t = {n: store.read_table(spark, root, n) for n in (P.FACT, P.PAGES, P.DEVICES)}
    from clickmart.operators import continued, gold

    whole = gold.with_session_windows(gold.enrich(t[P.FACT], t[P.PAGES], t[P.DEVICES]), t[P.FACT])
    columns = ["session_id", "n_rows", "first_day", "dayless", "last"]
    want = continued.state_of(whole, 0).select(columns)
    got = continued.newest(store.read_table(spark, root, S.SESSION_STATE)).select(columns)
    assert rows(got) == rows(want)
    assert {r["session_id"] for r in got.collect()} >= {None, "all", "s1"}


def test_refresh_reads_days_it_needs(replay):
    """The second delivery goes on from old sessions: no old fact or page day is read, and
    the third reads the fact only from the first day of the disturbed sessions."""
    _, _, asked = replay
    gold_tables = (P.FACT, P.PAGES, P.ALL_EVENTS)

    def old_days(n):
        return {(t, p.rsplit("extract_date=")[-1]) for t, p in asked[n]
                if t in gold_tables and f"/run={n}/" not in f"{p}/"}

    # the journey's mark is the day before the delivery: its day is listed
    assert old_days(1) <= {(P.FACT, "2024-01-02")}
    assert not any(t == P.ALL_EVENTS for t, _ in old_days(2) | old_days(3) | old_days(4))
    assert (P.FACT, "2024-01-01") in old_days(2)  # "all" is windowed again
    assert (P.PAGES, "2024-01-02") in old_days(3)  # k1 came again
    # s5 has a row without a time, after which nothing sorts: it is windowed again each time
    assert {d for _, d in old_days(4)} <= {"2024-01-03", "2024-01-04", "2024-01-05"}


def test_late_report_from_kept_rows(spark, replay):
    from clickmart.operators import marks

    root = replay[0]
    want = marks.late_rows(store.read_table(spark, root, P.BASE), store.read_table(spark, root, P.FACT))
    got = R.late_report(spark, root)
    assert rows(got) == rows(want)
    assert "x1" in {r["event_uuid"] for r in got.collect()}
    assert store.read_table(spark, root, S.LATE).count() < store.read_table(spark, root, P.BASE).count()


def test_nothing_new_starts_no_query(spark, replay, monkeypatch):
    root, landing, _ = replay

    def never(*_, **__):
        raise AssertionError("a query was started")

    monkeypatch.setattr(ingest, "run_available_now", never)
    assert R.run_increment(spark, root, landing, STAMPS[-1]) == \
        {"raw_rows": 0, "base_rows": 0, "refreshed": 0}
    # a lost note costs a run, not rows
    monkeypatch.undo()
    os.remove(glob.glob(f"{root}/_checkpoints/ingest.seen")[0])
    assert R.run_increment(spark, root, landing, STAMPS[-1])["raw_rows"] == 0


# --- key filters -----------------------------------------------------------------

def test_filters_miss_no_key(spark):
    days = [date(2024, 1, 1), date(2024, 1, 2), None]
    held = {d: {f"{i}-{k}" for k in range(300 * (i + 1))} for i, d in enumerate(days)}
    df = spark.createDataFrame([(k, d) for d, ks in held.items() for k in ks] + [(None, days[0])],
                               "k string, d date")
    for shard_keys in (1 << 18, 16):
        known = keyfilter.filters(df, F.col("k"), F.col("d"), 4, shard_keys)
        known = spark.createDataFrame(known.collect(), known.schema)
        assert known.count() >= 3 if shard_keys > 16 else known.count() > 60
        for asked in (1 << 17, 3):
            for d in days:
                keys = spark.createDataFrame([(sorted(held[d])[7],), (None,), ("none",)], "x string")
                assert keyfilter.hits(known, keys, "x", asked) == [(4, d)]
        every = spark.createDataFrame([(k,) for ks in held.values() for k in ks], "x string")
        assert sorted(keyfilter.hits(known, every, "x", 50), key=str) == \
            sorted(((4, d) for d in days), key=str)
    assert keyfilter.hits(known, keys.where("false"), "x") == []
    assert keyfilter.hits(known.where("false"), keys, "x") == []


def test_false_hits_are_rare():
    rng = np.random.default_rng(1)
    for n in (3, 40, 700, 200_000):
        held, others = rng.integers(-2 ** 63, 2 ** 63, n), rng.integers(-2 ** 63, 2 ** 63, 300_000)
        n_bits, bits = keyfilter._bits(held)
        assert len(bits) == max(8, -(-n * 32 // 64) * 8)
        assert len(keyfilter._holds(bits, n_bits, held)) == n
        assert len(keyfilter._holds(bits, n_bits, others)) <= 3


# --- summaries and merging ----------------------------------------------------------

def page_row(spark, n):
    return spark.sql(f"""select 'e{n}' event_uuid, 'u' page_url, {n}L page_counter, 't' page_title,
        'p' parent_page_title, 'x' element_text, 'a' element_tag, 'u' element_url,
        timestamp_ntz '2024-01-{1 + n % 3:02d} 01:00:00' extract_timestamp,
        timestamp_ntz '2024-02-01 00:00:00' load_timestamp""")


def test_small_folders_are_merged_and_old_ones_go(spark):
    root = scratch_path(spark, "test-merge").removeprefix("file:")
    spark.conf.set(store.MERGE_CONF, "3")
    try:
        for n in range(10):
            store.write_table(page_row(spark, n), root, P.PAGES, n)
            store.complete(spark, root, n, build=n == 0)
            got = store.read_table(spark, root, P.PAGES).select("event_uuid").collect()
            assert sorted(r[0] for r in got) == [f"e{i}" for i in range(n + 1)], n
    finally:
        spark.conf.unset(store.MERGE_CONF)
    known = store.summary(spark, root)
    assert known.run == 9
    # 0-8 in one folder, 9 alone
    assert {x.folder for x in known.of(P.PAGES)} == {"run=8_0", "run=9"}
    assert {(x.day.day, x.n_rows) for x in known.of(P.PAGES) if x.folder == "run=8_0"} == \
        {(1, 3), (2, 3), (3, 3)}
    assert str(known.high(P.PAGES)) == "2024-01-03 01:00:00"
    left = {os.path.basename(x) for x in glob.glob(f"{root}/{P.PAGES}/run=*")}
    named = {x.folder for n in (7, 8, 9) for x in store.summary(spark, root, n).of(P.PAGES)}
    assert left == named
    assert len(glob.glob(f"{root}/_progress/*")) == store.KEEP_SUMMARIES
    # readers of the two runs before still see what they saw
    assert store.read_table(spark, root, P.PAGES, 7).count() == 8
    with pytest.raises(RuntimeError, match="expired"):
        store.read_table(spark, root, P.PAGES, 3)


def test_an_unfinished_summary_does_not_count(spark):
    root = scratch_path(spark, "test-unfinished").removeprefix("file:")
    store.write_table(page_row(spark, 0), root, P.PAGES, 0)
    store.complete(spark, root, 0, build=True)
    store.write_table(page_row(spark, 1), root, P.PAGES, 1)
    store.complete(spark, root, 1)
    os.remove(f"{root}/_progress/run=1/_SUCCESS")
    assert store.last_run(spark, root) == 0
    assert store.read_table(spark, root, P.PAGES).count() == 1
    assert store.runs(spark, root, P.PAGES, 1) == [0, 1]  # written, not recorded


def test_file_system_calls_do_not_grow_with_runs(spark, monkeypatch):
    """A refresh after 200 more runs asks the file system as often as one after none."""
    root = scratch_path(spark, "test-200").removeprefix("file:")
    landing = f"{root}/landing"
    deliver(f"{landing}/d0", DELIVERIES[0])
    R.initial_build(spark, root, landing, STAMPS[0])
    calls, paths = [], []
    fs, read = store._jvm_fs, store._from_paths
    monkeypatch.setattr(store, "_jvm_fs", lambda s, p: (calls.append(p), fs(s, p))[1])
    monkeypatch.setattr(store, "_from_paths", lambda s, r, n, p: (paths.extend(p), read(s, r, n, p))[1])

    def refresh(n):
        calls.clear(), paths.clear()
        deliver(f"{landing}/d{n}", [(event(f"f{n}", "s1", at(20 + n, 1), url=URL), file_of(20 + n, 1))])
        assert R.run_increment(spark, root, landing, STAMPS[n])["refreshed"] == 1
        return len(calls), len(paths)

    few = refresh(1)
    # 200 runs: the folders of run 1 once more each, recorded as such runs record them
    known = store.summary(spark, root)
    leaves = list(known.leaves)
    for n in range(2, 202):
        for x in [x for x in known.leaves if x.run == 1 and x.table_name not in store.SNAPSHOT]:
            folder = f"{root}/{x.table_name}/run={n}"
            if not os.path.exists(folder):
                shutil.copytree(f"{root}/{x.table_name}/run=1", folder)
            leaves.append(x._replace(folder=f"run={n}", first_run=n, run=n))
    for x in [x for x in known.leaves if x.run == 1 and x.table_name in store.SNAPSHOT]:
        shutil.copytree(f"{root}/{x.table_name}/run=1", f"{root}/{x.table_name}/run=201")
        leaves.append(x._replace(folder="run=201", first_run=201, run=201))
    spark.conf.set(store.MERGE_CONF, "64")
    try:
        leaves = store._merged(spark, root, leaves, set())
    finally:
        spark.conf.unset(store.MERGE_CONF)
    store.record(spark, root, 201, leaves)
    assert store.last_run(spark, root) == 201
    many = refresh(2)
    assert many[0] <= few[0] + 12  # merged folders that go, no more
    assert many[1] <= few[1] + 80  # some folders of each of the tables that say where to look
    assert store.read_table(spark, root, P.FACT).count() == 8 + 201 + 1


# --- landing ----------------------------------------------------------------------

def test_archived_files_are_not_listed_again(spark):
    """Loaded files leave the landing folder; an old time or name does not keep a file out."""
    root = scratch_path(spark, "test-archive").removeprefix("file:")
    landing, archive = f"{root}/landing", f"{root}/archive"
    deliver(f"{landing}/d0", [(event(f"e{i}", "s", at(1, 1)), file_of(1, 1, i)) for i in range(40)])
    R.load_bronze(spark, root, landing, STAMPS[0], archive=archive)
    deliver(f"{landing}/d1", [(event("f", "s", at(2, 1)), file_of(2, 1))])
    R.load_bronze(spark, root, landing, STAMPS[1], archive=archive)
    deliver(f"{landing}/d0", [(event("g", "s", at(1, 1)), file_of(1, 1, 99))])
    old = f"{landing}/d0/{file_of(1, 1, 99)}"
    os.utime(old, (1_500_000_000,) * 2)
    n = R.load_bronze(spark, root, landing, STAMPS[2], archive=archive)
    assert n == {"raw_rows": 1, "base_rows": 1}
    listed = [f for f in glob.glob(f"{landing}/**/*.json", recursive=True)]
    assert len(listed) <= 2  # the last batch's, and what came with it
    assert len(glob.glob(f"{archive}/**/*.json", recursive=True)) >= 40
    audit = R.landing_audit(spark, root, landing, archive).collect()
    assert len(audit) == 42 and all(r["listed"] and r["n_rows"] == 1 for r in audit)

"""Change feeds: own offsets, nothing lost or doubled when a run dies, and the audit's state."""

import glob

import pytest

from clickmart import schemas as S
from clickmart.operators import silver
from clickmart.plans import refresh as R
from clickmart.session import scratch_path
from clickmart.sources.raw import load_audit
from clickmart.streaming import feed
from clickmart.streaming.ingest import ingest_files, raw_to_base
from tests.conftest import event
from tests.test_streaming import _write

STAMP = "2026-01-01 00:00:00"
DDL = S.TABLE_DDL["events_base"]


class Feed:
    """A raw table and events_base that grow file by file, and consumers of the latter."""

    def __init__(self, spark, name):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0
        self.raw, self.base = f"{self.root}/raw", f"{self.root}/base"

    def grow(self, *uuids):
        self.n += 1
        _write(self.spark, f"{self.root}/landing", f"0_2024-01-01_{self.n}",
               [event(u, "s1", "2024-01-01 01:00:00") for u in uuids])
        ingest_files(self.spark, f"{self.root}/landing", self.raw, f"{self.root}/ck1")
        raw_to_base(self.spark, self.raw, self.base, f"{self.root}/ck2", STAMP)

    def follow(self, name, written=lambda batch: None):
        table = self.spark.readStream.schema(DDL).parquet(self.base)
        return feed.follow(table, f"{self.root}/{name}", f"{self.root}/ck-{name}",
                           lambda rows: silver.fact(rows, STAMP), written)

    def got(self, name):
        rows = feed.read_followed(self.spark, f"{self.root}/{name}",
                                  S.TABLE_DDL["fct_all_session_events"]).collect()
        return sorted(r["event_uuid"] for r in rows)


def test_consumers_follow_at_their_own_pace(spark):
    f = Feed(spark, "test-feed-pace")
    f.grow("a", "b")
    assert f.got("one") == [] and f.follow("one") == 2 and f.follow("one") == 0
    f.grow("c")
    f.grow("d", "d")
    assert f.follow("one") == 3  # what came since its own last batch
    assert f.follow("two") == 5  # a new consumer starts at the first row
    assert f.got("one") == f.got("two") == ["a", "b", "c", "d", "d"]


def test_a_run_that_dies_between_sink_and_offset(spark):
    f = Feed(spark, "test-feed-dies")
    f.grow("a")
    f.follow("one")
    f.grow("b", "c")

    def die(batch):
        raise RuntimeError("the driver is lost")

    for _ in range(2):
        with pytest.raises(Exception, match="the driver is lost"):
            f.follow("one", die)
        assert f.got("one") == ["a", "b", "c"]  # written, its offset not committed
    f.grow("d")  # comes after the batch that was under way, and is not part of it
    f.follow("one")
    assert f.got("one") == ["a", "b", "c", "d"]
    assert f.follow("one") == 0


def test_a_batch_that_was_not_written_whole_is_not_read(spark):
    f = Feed(spark, "test-feed-part")
    f.grow("a")

    def broken(rows):
        return silver.fact(rows, STAMP).selectExpr(
            "* except (event_uuid)", "raise_error(event_uuid) as event_uuid")

    table = spark.readStream.schema(DDL).parquet(f.base)
    with pytest.raises(Exception):
        feed.follow(table, f"{f.root}/one", f"{f.root}/ck-one", broken)
    assert feed.finished_batches(spark, f"{f.root}/one") == [] and f.got("one") == []
    assert f.follow("one") == 1 and f.got("one") == ["a"]


def test_audit_reads_what_came_since(spark):
    f = Feed(spark, "test-feed-audit")
    counts, ck = f"{f.root}/counts", f"{f.root}/ck-audit"
    read = []
    for uuids in (("a", "b"), ("c",), ("d", "e", "f")):
        f.grow(*uuids)
        read.append(feed.count_files(spark, f.raw, counts, ck))
        raw = spark.read.schema(S.RAW_SCHEMA).parquet(f.raw)
        assert sorted(feed.counted_files(spark, counts).collect()) == sorted(
            load_audit(raw).collect())
    assert read == [2, 1, 3] and feed.count_files(spark, f.raw, counts, ck) == 0


def test_stored_audit_keeps_its_state(spark):
    root = scratch_path(spark, "test-audit-state")
    landing = f"{root}/landing"
    _write(spark, landing, "0_2024-01-01_1", [event("a", "s", "2024-01-01 01:00:00")] * 2)
    R.load_bronze(spark, root, landing, STAMP)
    _write(spark, landing, "0_2024-01-01_2", [event("b", "s", "2024-01-01 02:00:00")])
    for expected in ([0, 2], [0, 2]):  # the second audit starts no query
        rows = R.landing_audit(spark, root, landing).collect()
        assert sorted(r["n_rows"] for r in rows) == expected and all(r["listed"] for r in rows)
    R.load_bronze(spark, root, landing, STAMP)
    assert sorted(r["n_rows"] for r in R.landing_audit(spark, root, landing).collect()) == [1, 2]
    batches = glob.glob(f"{root.removeprefix('file:')}/{R.FILE_COUNTS}/batch=*")
    assert len(batches) == 2

"""A run that fails anywhere is finished by the next one, with nothing lost or doubled."""

import pytest
from pyspark.sql import functions as F

from clickmart.plans import pipeline as P
from clickmart.plans import queries as Q
from clickmart.plans import refresh as R
from clickmart.plans import store
from clickmart.session import scratch_path

SF = "/root/testdata/sf0.001"
TABLES = (P.BASE, P.FACT, P.PAGES, P.DEVICES, P.ALL_EVENTS, P.JOURNEY)


def _rows(spark, root):
    return {n: sorted(tuple(map(str, r)) for r in store.read_table(spark, root, n).collect())
            for n in TABLES}


def _lines(spark):
    """The files of three days around the cut."""
    lines = Q.raw_json_lines(*Q.tables(spark, SF))
    return lines.where(F.col("filename").rlike("2024-01-1[789]_"))


def _deliver(spark, landing, which):
    lines = _lines(spark)
    first = Q.first_delivery(F.col("filename"))
    Q.write_json_lines(lines.where(first if which == 1 else ~first), landing, mode="append")


def _first(spark, name):
    root = scratch_path(spark, name)
    landing = f"{root}/landing"
    _deliver(spark, landing, 1)
    R.initial_build(spark, root, landing, Q.LOAD_TS_1)
    _deliver(spark, landing, 2)
    return root, landing


@pytest.fixture(scope="module")
def undisturbed(spark):
    root, landing = _first(spark, "test-undisturbed")
    R.run_increment(spark, root, landing, Q.LOAD_TS_2)
    return _rows(spark, root)


class Failure(Exception):
    pass


@pytest.mark.parametrize(("table", "half_written"), [
    (P.FACT, True), (R.DEVICE_STATE, False), (P.DEVICES, True), (P.JOURNEY, False)])
def test_failure_before_a_table_is_finished(spark, monkeypatch, undisturbed, table, half_written):
    root, landing = _first(spark, f"test-fail-{table}")
    before = _rows(spark, root)
    write = R.write_table

    def failing(df, root_, name, run):
        if name == table:
            if half_written:  # rows are there, the mark that they are complete is not
                write(df.limit(3), root_, name, run)
                fs, p, _ = store._jvm_fs(spark, f"{root_}/{name}/run={run}/_SUCCESS")
                fs.delete(p, False)
            raise Failure(name)
        write(df, root_, name, run)

    monkeypatch.setattr(R, "write_table", failing)
    with pytest.raises(Failure):
        R.run_increment(spark, root, landing, Q.LOAD_TS_2)
    for name in TABLES[1:]:  # readers still see the state before the run
        assert _rows(spark, root)[name] == before[name]
    monkeypatch.undo()
    again = R.run_increment(spark, root, landing, Q.LOAD_TS_2)  # no new files
    assert again == {"raw_rows": 0, "base_rows": 0, "refreshed": 1}
    assert _rows(spark, root) == undisturbed
    assert R.run_increment(spark, root, landing, Q.LOAD_TS_2)["refreshed"] == 0


def test_failure_right_after_bronze_and_more_files_before_the_retry(spark, monkeypatch,
                                                                    undisturbed):
    root = scratch_path(spark, "test-fail-bronze")
    landing = f"{root}/landing"
    _deliver(spark, landing, 1)
    R.initial_build(spark, root, landing, Q.LOAD_TS_1)
    second = _lines(spark).where(~Q.first_delivery(F.col("filename")))
    some = F.col("filename").contains("2024-01-19")
    Q.write_json_lines(second.where(some), landing, mode="append")
    monkeypatch.setattr(R, "refresh_silver", lambda *a, **k: (_ for _ in ()).throw(Failure()))
    with pytest.raises(Failure):
        R.run_increment(spark, root, landing, Q.LOAD_TS_2)
    monkeypatch.undo()
    Q.write_json_lines(second.where(~some), landing, mode="append")
    R.run_increment(spark, root, landing, Q.LOAD_TS_2)
    assert _rows(spark, root) == undisturbed


def test_one_load_stamp_for_every_run_loses_nothing(spark, undisturbed):
    """The stamp is only a value: runs are told apart by their number."""
    root, landing = _first(spark, "test-same-stamp")
    R.run_increment(spark, root, landing, Q.LOAD_TS_1)
    got = _rows(spark, root)
    for name in TABLES:
        assert len(got[name]) == len(undisturbed[name]), name

    def ids(rows):
        return [r[0] for r in rows[P.DEVICES]]

    assert ids(got) == ids(undisturbed)


def test_a_second_build_replaces_the_first(spark, undisturbed):
    root, landing = _first(spark, "test-rebuild")
    R.initial_build(spark, root, landing, Q.LOAD_TS_2)
    got = _rows(spark, root)
    assert len(got[P.FACT]) == len(got[P.ALL_EVENTS]) == _lines(spark).count()
    # a merge adds one more NULL device to those of a build
    without = _lines(spark).where(F.get_json_object("json_text", "$.device_id").isNull())
    in_first = without.where(Q.first_delivery(F.col("filename"))).count()
    assert len(got[P.DEVICES]) == len(undisturbed[P.DEVICES]) - (in_first > 0)


def test_old_device_snapshots_go(spark):
    root, landing = _first(spark, "test-expire")
    for i in range(4):
        Q.write_json_lines(_lines(spark).limit(2), f"{landing}/more{i}")
        R.run_increment(spark, root, landing, Q.LOAD_TS_2)
    for name in store.SNAPSHOT:
        assert store.runs(spark, root, name, 99) == [2, 3, 4]

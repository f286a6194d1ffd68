"""Exactly-once ingest and the raw -> bronze stream."""

import json

from pyspark.sql import functions as F

from clickmart.operators import marks
from clickmart.operators.silver import fact
from clickmart.session import scratch_path
from clickmart.streaming.ingest import ingest_files, raw_to_base
from tests.conftest import event


def _write(spark, folder, name, events):
    # one JSON object per line, written the way an exporter drops a file
    path = f"{folder}/{name}"
    lines = [json.dumps(e) for e in events]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_files_load_once_and_stream_to_base(spark):
    root = scratch_path(spark, "test-stream")
    src, raw, base = f"{root}/landing", f"{root}/raw", f"{root}/base"
    _write(spark, src, "0_2024-01-01_1", [event("a", "s1", "2024-01-01 01:00:00"),
                                          event("b", "s1", "2024-01-01 01:00:05")])
    assert ingest_files(spark, src, raw, f"{root}/ck1") == 2
    assert ingest_files(spark, src, raw, f"{root}/ck1") == 0  # re-run loads nothing
    assert raw_to_base(spark, raw, base, f"{root}/ck2", "2026-01-01 00:00:00") == 2
    assert raw_to_base(spark, raw, base, f"{root}/ck2", "2026-01-01 00:00:00") == 0
    _write(spark, src, "0_2024-01-01_2", [event("c", "s1", "2024-01-01 02:00:00")])
    assert ingest_files(spark, src, raw, f"{root}/ck1") == 1
    assert raw_to_base(spark, raw, base, f"{root}/ck2", "2026-01-02 00:00:00") == 1
    b = spark.read.parquet(base)
    got = {r["event_uuid"]: (r["extract_timestamp"].hour, r["load_timestamp"].day) for r in b.collect()}
    assert got == {"a": (1, 1), "b": (1, 1), "c": (2, 2)}
    assert spark.read.parquet(raw).select("filename").distinct().count() == 2


def test_second_file_of_loaded_hour_is_late(spark):
    root = scratch_path(spark, "test-late")
    src, raw, base = f"{root}/landing", f"{root}/raw", f"{root}/base"
    _write(spark, src, "0_2024-01-01_1", [event("a", "s1", "2024-01-01 01:00:00")])
    ingest_files(spark, src, raw, f"{root}/ck1")
    raw_to_base(spark, raw, base, f"{root}/ck2", "2026-01-01 00:00:00")
    fct = fact(spark.read.parquet(base), "2026-01-01 00:00:00")
    fct_rows = fct.collect()
    _write(spark, src, "1_2024-01-01_1", [event("late", "s1", "2024-01-01 01:30:00")])
    ingest_files(spark, src, raw, f"{root}/ck1")
    raw_to_base(spark, raw, base, f"{root}/ck2", "2026-01-02 00:00:00")
    base_df = spark.read.parquet(base)
    fct_df = spark.createDataFrame(fct_rows, fct.schema)
    from clickmart.operators.silver import fact_increment
    appended = fact_increment(base_df, fct_df, "2026-01-02 00:00:00")
    assert appended.count() == 0  # same hour as the mark: never reaches the fact
    fct_after = fct_df.unionByName(appended)
    late = marks.late_rows(base_df, fct_after).select("event_uuid").collect()
    assert [r["event_uuid"] for r in late] == ["late"]
    assert base_df.where(F.col("event_uuid") == "late").count() == 1


def test_continuous_ingest_shares_the_file_log(spark):
    from clickmart.streaming.ingest import start_ingest

    root = scratch_path(spark, "test-cont")
    src, raw = f"{root}/landing", f"{root}/raw"
    _write(spark, src, "0_2024-01-01_1", [event("a", "s1", "2024-01-01 01:00:00")])
    q = start_ingest(spark, src, raw, f"{root}/ck", interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(raw).count() == 1
    _write(spark, src, "0_2024-01-01_2", [event("b", "s1", "2024-01-01 02:00:00")])
    assert ingest_files(spark, src, raw, f"{root}/ck") == 1  # only the new file


def test_snapshot_versions_skip_unfinished_folders(spark):
    from clickmart.plans import store

    root = scratch_path(spark, "test-snap")
    dev = spark.createDataFrame([("d1", "m", "f", "iOS", "1", "o", None)],
                                "device_id string, device_type string, device_family string, "
                                "platform string, os_version string, os_name string, load_timestamp timestamp_ntz")
    store.write_table(dev, root, "dim_devices", 0)
    # a writer that died half-way: folder without _SUCCESS
    dev.write.parquet(f"{root}/dim_devices/run=1/_temporary_dead")
    assert store.runs(spark, root, "dim_devices", 9) == [0]
    assert store.read_table(spark, root, "dim_devices", 1).first()["os_name"] == "o"
    store.write_table(dev.withColumn("os_name", F.lit("new")), root, "dim_devices", 1)
    assert store.runs(spark, root, "dim_devices", 9) == [0, 1]
    assert store.read_table(spark, root, "dim_devices", 1).first()["os_name"] == "new"
    assert store.read_table(spark, root, "dim_devices", 0).first()["os_name"] == "o"


def test_backlog_in_several_micro_batches(spark):
    root = scratch_path(spark, "test-backlog")
    src, raw = f"{root}/landing", f"{root}/raw"
    for h in range(3):
        _write(spark, src, f"0_2024-01-01_{h}", [event(f"e{h}", "s1", f"2024-01-01 0{h}:00:00")])
    assert ingest_files(spark, src, raw, f"{root}/ck", max_files_per_trigger=1) == 3
    assert spark.read.parquet(raw).count() == 3


def test_exact_count_over_more_micro_batches_than_a_query_remembers(spark):
    root = scratch_path(spark, "test-many")
    src, raw = f"{root}/landing", f"{root}/raw"
    lines = spark.range(130).selectExpr(
        "concat('{\"uuid\":\"', id, '\"}') as json_text",
        "concat('data/0_2024-01-', lpad(cast(1 + id div 24 as string), 2, '0'), '_', id % 24, "
        "'#0.json') as filename")
    from clickmart.sources.driver_tables import write_json_lines

    write_json_lines(lines, src)
    assert ingest_files(spark, src, raw, f"{root}/ck", max_files_per_trigger=1) == 130
    assert spark.read.parquet(raw).count() == 130


def test_files_with_an_old_time_are_loaded(spark):
    """A backfill that keeps its files' times, after newer files were loaded."""
    import glob
    import os
    import time

    root = scratch_path(spark, "test-old")
    src, raw = f"{root}/landing", f"{root}/raw"
    _write(spark, src, "0_2024-01-01_1", [event("a", "s1", "2024-01-01 01:00:00")])
    assert ingest_files(spark, src, raw, f"{root}/ck") == 1
    before = set(glob.glob(f"{src}/**/*", recursive=True))
    _write(spark, src, "0_2024-01-01_0", [event("b", "s1", "2024-01-01 00:00:00")])
    for f in set(glob.glob(f"{src}/**/*", recursive=True)) - before:
        os.utime(f, (time.time() - 20 * 86400,) * 2)
    assert ingest_files(spark, src, raw, f"{root}/ck") == 1
    assert ingest_files(spark, src, raw, f"{root}/ck") == 0
    assert spark.read.parquet(raw).count() == 2

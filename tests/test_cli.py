"""The command line runs the stored pipeline: build, refresh, late report."""

import json

import pytest

from clickmart.__main__ import main
from clickmart.plans import queries as Q
from clickmart.plans import refresh as R
from clickmart.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_build_refresh_and_late_report(spark, capsys):
    root = scratch_path(spark, "test-cli")
    landing, tables = f"{root}/landing", f"{root}/tables"
    # late delivery replay: hour-23 files before the cut come with batch 2
    lines = Q.raw_json_lines(*Q.tables(spark, SF))
    from pyspark.sql import functions as F

    first = Q.first_delivery(F.col("filename"), late=True)
    Q.write_json_lines(lines.where(first), landing, mode="append")
    main(["build", "--root", tables, "--landing", landing, "--load-ts", Q.LOAD_TS_1])
    built = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    Q.write_json_lines(lines.where(~first), landing, mode="append")
    main(["refresh", "--root", tables, "--landing", landing, "--load-ts", Q.LOAD_TS_2,
          "--max-files-per-trigger", "50"])
    refreshed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert built["base_rows"] + refreshed["base_rows"] == 1000
    assert refreshed["refreshed"] == 1
    audit = R.landing_audit(spark, tables, landing)
    assert audit.where(~F.col("listed") | (F.col("n_rows") == 0)).count() == 0
    assert audit.agg(F.sum("n_rows")).first()[0] == 1000
    late = R.late_report(spark, tables)
    assert late.count() == 19  # as the late_rows query (oracle-checked)
    assert late.where(F.hour("extract_timestamp") != 23).count() == 0


def test_layers_one_by_one(spark, capsys, monkeypatch):
    """A refresh whose silver fails is finished by the layer commands."""
    root = scratch_path(spark, "test-cli-layers")
    landing, tables = f"{root}/landing", f"{root}/tables"
    Q._write_delivery(spark, SF, landing, 1)
    with pytest.raises(RuntimeError, match="full build first"):
        main(["refresh", "--root", tables, "--landing", landing])
    main(["build", "--root", tables, "--landing", landing, "--load-ts", Q.LOAD_TS_1])
    Q._write_delivery(spark, SF, landing, 2)
    R.load_bronze(spark, tables, landing, Q.LOAD_TS_2)
    with pytest.raises(RuntimeError, match="silver layer first"):
        main(["gold", "--root", tables])
    main(["silver", "--root", tables, "--load-ts", Q.LOAD_TS_2])
    main(["gold", "--root", tables])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"gold": 1}
    assert R.store.read_table(spark, tables, "all_events").count() == 1000
    with pytest.raises(SystemExit):
        main(["refresh", "--root", tables])

"""Tables on shared storage: parquet folders under one root.

Fact-like tables are partitioned by ``extract_date``, the day of the file
hour ``extract_timestamp``. Days, not hours: an hour of a small feed is a tiny
file, a day of a large one is split by AQE into files of the advisory size.

Every run writes a folder of its own, ``run=<n>``, in overwrite mode, and a
folder counts only when it is finished (``_SUCCESS``). A run that failed is
done again under its number: its half-written folders are replaced, so no row
is lost or doubled. The bronze table is written by a stream, exactly once per
file, with the run in which its rows arrived as a partition (``load_run``).

``_progress/run=<n>`` (``build=<n>`` for a full build) is written last and is
the run's summary: one row for each folder and day of every table, with its row
count and highest stamp. Readers take the newest summary in one small scan; it
tells which folders make up a table, which days they hold and the tables'
high-water marks, so none of that is looked up folder by folder, and readers see
finished runs only, all tables changed together. A full build starts a summary
of its own: folders of earlier runs are no longer part of any table.

Small folders are merged when a run is recorded: as soon as ``MERGE_AT``
neighbouring folders of a table span about as many runs each, they become one,
``run=<last>_<first>``, whose files are ranges of the table's order inside each day. A table of n runs thus has a number of folders that
grows with log n, and a row is rewritten that often. The last
``KEEP_SUMMARIES`` summaries stay readable; folders that only older ones name
are removed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import date, datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators.marks import PARTITION_COLUMN

STAMP_COLUMN = "extract_timestamp"
PARTITIONED = {"events_base", "fct_all_session_events", "dim_event_pages", "all_events",
               "session_journey"}
SNAPSHOT = {"dim_devices", "device_state"}
# Tables without days to which every run adds rows.
APPENDED = {S.SESSION_STATE, S.FACT_KEYS, S.PAGE_KEYS, S.STATE_KEYS, S.LATE}
# Row order inside written files (clusters row-group statistics for readers).
WRITE_ORDER = {
    "all_events": ["session_id", "event_time"],
    "session_journey": ["session_id"],
    "fct_all_session_events": ["session_id", "event_time"],
    "dim_event_pages": ["event_uuid"],
    "dim_devices": ["device_id"],
    S.SESSION_STATE: ["session_id"],
}

RUN_COLUMN = "load_run"
PROGRESS = "_progress"
KEEP_SNAPSHOTS = 3
KEEP_SUMMARIES = 3
MERGE_AT = 16
MERGE_CONF = "spark.clickmart.store.mergeRuns"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
SUMMARY_DDL = ("table_name string, folder string, first_run int, run int, day date, "
               "n_rows bigint, high timestamp_ntz")


class Leaf(NamedTuple):
    """One day of one folder of a table (``day`` None: no day), over runs ``first_run..run``."""

    table_name: str
    folder: str
    first_run: int
    run: int
    day: date | None
    n_rows: int
    high: datetime | None


class Summary(NamedTuple):
    """What the tables consist of after ``run`` (-1: before the first build)."""

    run: int
    leaves: tuple[Leaf, ...]

    def of(self, name: str) -> list[Leaf]:
        return [x for x in self.leaves if x.table_name == name]

    def high(self, name: str) -> datetime | None:
        return max((x.high for x in self.of(name) if x.high is not None), default=None)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# --- the file system ----------------------------------------------------------

def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _jvm_fs(spark, path)
    return fs.exists(p)


def _finished(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/_SUCCESS")


def _remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _jvm_fs(spark, path)
    fs.delete(p, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (one listing)."""
    fs, p, jvm = _jvm_fs(spark, path)
    try:
        found = fs.listStatus(p)
    except Exception as e:  # noqa: BLE001 - a table that has not been written yet
        if "FileNotFoundException" in str(e):
            return []
        raise
    return [st.getPath().getName() for st in found if st.isDirectory()]


# --- summaries ------------------------------------------------------------------

def _recorded(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, folder name) of all summaries, finished or not, newest first."""
    found = [re.fullmatch(r"(run|build)=(\d+)", x) for x in _folders(spark, table_path(root, PROGRESS))]
    return sorted(((int(m[2]), m[0]) for m in found if m), reverse=True)


_read_before: dict[str, Summary] = {}  # a finished summary never changes


def _read_summary(spark: SparkSession, path: str, run: int) -> Summary:
    if path not in _read_before:
        if len(_read_before) >= 2 * KEEP_SUMMARIES:
            _read_before.clear()
        rows = spark.read.schema(SUMMARY_DDL).parquet(path).collect()
        _read_before[path] = Summary(run, tuple(Leaf(*r) for r in rows))
    return _read_before[path]


def summary(spark: SparkSession, root: str, upto: int | None = None) -> Summary:
    """The newest summary, or the newest of a run up to ``upto``."""
    path = table_path(root, PROGRESS)
    passed = False
    for run, name in _recorded(spark, root):
        if not _finished(spark, f"{path}/{name}"):
            continue
        if upto is None or run <= upto:
            return _read_summary(spark, f"{path}/{name}", run)
        passed = True
    if passed:
        raise RuntimeError(f"the summary of run {upto} has expired")
    return Summary(-1, ())


def last_run(spark: SparkSession, root: str) -> int:
    """The last completed run; -1 before the first build."""
    return summary(spark, root).run


def _pending(spark: SparkSession, root: str, name: str, after: int, upto: int) -> list[int]:
    """Finished runs of a table that no summary has recorded yet."""
    if upto <= after:
        return []
    found = [re.fullmatch(r"run=(\d+)", x) for x in _folders(spark, table_path(root, name))]
    return sorted(n for n in (int(m[1]) for m in found if m) if after < n <= upto
                  and _finished(spark, f"{table_path(root, name)}/run={n}"))


def runs(spark: SparkSession, root: str, name: str, upto: int) -> list[int]:
    """Runs that a table's folders end with, from the newest full build on."""
    known = summary(spark, root, upto)
    return sorted({x.run for x in known.of(name)}) + _pending(spark, root, name, known.run, upto)


def _stats(spark: SparkSession, root: str, names: list[str], run: int) -> list[Leaf]:
    """The leaves that ``run`` wrote: a count and a highest stamp by day, in one job."""
    folder = f"run={run}"

    def of(name: str) -> DataFrame:
        path = f"{table_path(root, name)}/{folder}"
        if name not in PARTITIONED:
            return spark.read.schema(S.TABLE_DDL[name]).parquet(path).agg(
                F.lit(None).cast("date").alias("day"), F.count(F.lit(1)).alias("n"),
                F.lit(None).cast("timestamp_ntz").alias("high")).withColumn("name", F.lit(name))
        ddl = f"{S.TABLE_DDL[name]}, {PARTITION_COLUMN} date"
        return spark.read.schema(ddl).parquet(path).groupBy(F.col(PARTITION_COLUMN).alias("day")).agg(
            F.count(F.lit(1)).alias("n"), F.max(STAMP_COLUMN).alias("high")).withColumn("name", F.lit(name))

    if not names:
        return []
    rows = reduce(DataFrame.unionByName, [of(n) for n in names]).collect()
    return [Leaf(r["name"], folder, run, run, r["day"], r["n"], r["high"]) for r in rows]


def _to_merge(leaves: list[Leaf], merge_at: int) -> list[list[tuple[int, int, str]]]:
    """Groups of ``merge_at`` neighbouring folders (first run, last run, name) of one size class.

    A class holds folders of up to ``merge_at`` times as many runs as the one below.
    """
    out, row = [], []

    def size_class(f: tuple[int, int, str]) -> int:
        k, n = 0, f[1] - f[0] + 1
        while n >= merge_at:
            k, n = k + 1, n // merge_at
        return k

    for f in sorted({(x.first_run, x.run, x.folder) for x in leaves}):
        if row and size_class(row[-1]) != size_class(f):
            row = []
        row.append(f)
        if len(row) == merge_at:
            out.append(row)
            row = []
    return out


def _merged(spark: SparkSession, root: str, leaves: list[Leaf],
            made: set[tuple[str, str]]) -> list[Leaf]:
    """``leaves`` after merging small folders (written here and added to ``made``)."""
    merge_at = int(spark.conf.get(MERGE_CONF, str(MERGE_AT)))
    names = sorted({x.table_name for x in leaves} & (PARTITIONED | APPENDED))
    for name in names:
        while groups := _to_merge([x for x in leaves if x.table_name == name], merge_at):
            for group in groups:
                first, last = group[0][0], group[-1][1]
                folder = f"run={last}_{first}"
                taken = {f for _, _, f in group}
                old = [x for x in leaves if x.table_name == name and x.folder in taken]
                _write(_read(spark, root, name, old), root, name, folder, ranged=True)
                made.add((name, folder))
                by_day = defaultdict(list)
                for x in old:
                    by_day[x.day].append(x)
                new = [Leaf(name, folder, first, last, day, sum(x.n_rows for x in xs),
                            max((x.high for x in xs if x.high is not None), default=None))
                       for day, xs in by_day.items()]
                leaves = [x for x in leaves if x not in old] + new
    return leaves


def complete(spark: SparkSession, root: str, run: int, build: bool = False) -> None:
    """Record ``run`` as done: its summary, merged folders, and an end to what is too old."""
    names = [n for n in S.TABLE_DDL if n != "events_base"
             and _finished(spark, f"{table_path(root, n)}/run={run}")]
    before = () if build else summary(spark, root, run - 1).leaves
    leaves = [*before, *_stats(spark, root, names, run)]
    for name in SNAPSHOT:
        kept = sorted({x.run for x in leaves if x.table_name == name})[-KEEP_SNAPSHOTS:]
        leaves = [x for x in leaves if x.table_name != name or x.run in kept]
    made = {(x.table_name, x.folder) for x in leaves if x.run == run}
    leaves = _merged(spark, root, leaves, made)
    record(spark, root, run, leaves, build)
    # no summary ever named what was merged at once
    for name, folder in sorted(made - {(x.table_name, x.folder) for x in leaves}):
        _remove(spark, f"{table_path(root, name)}/{folder}")


def record(spark: SparkSession, root: str, run: int, leaves: list[Leaf],
           build: bool = False) -> None:
    """Write the summary of ``run`` and remove what only expired summaries name."""
    path = table_path(root, PROGRESS)
    spark.createDataFrame([tuple(x) for x in leaves], SUMMARY_DDL).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/{'build' if build else 'run'}={run}")
    done = [(n, f) for n, f in _recorded(spark, root) if n <= run]
    kept, gone = done[:KEEP_SUMMARIES], done[KEEP_SUMMARIES:]
    in_use = {(x.table_name, x.folder) for n, f in kept for x in
              (leaves if n == run else _read_summary(spark, f"{path}/{f}", n).leaves)}
    for n, f in gone:
        old = _read_summary(spark, f"{path}/{f}", n).leaves
        for name, folder in sorted({(x.table_name, x.folder) for x in old} - in_use):
            _remove(spark, f"{table_path(root, name)}/{folder}")
        _remove(spark, f"{path}/{f}")


def has_run(spark: SparkSession, root: str, name: str, run: int) -> bool:
    """Whether ``run``, under way, has finished its part of a table."""
    return _finished(spark, f"{table_path(root, name)}/run={run}")


def run_has_bronze(spark: SparkSession, root: str, run: int) -> bool:
    """Whether bronze rows arrived in ``run``, in this attempt or an earlier one."""
    return _exists(spark, f"{table_path(root, 'events_base')}/{RUN_COLUMN}={run}")


# --- tables ---------------------------------------------------------------------

def with_partition_column(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(STAMP_COLUMN)))


def _layout(name: str) -> tuple[str, list[str]]:
    """DDL and columns of a table as it is read back."""
    if name in PARTITIONED:
        return (f"{S.TABLE_DDL[name]}, {PARTITION_COLUMN} date",
                [*S.TABLE_COLUMNS[name], PARTITION_COLUMN])
    return S.TABLE_DDL[name], list(S.TABLE_COLUMNS[name])


def _from_paths(spark: SparkSession, root: str, name: str, paths: list[str]) -> DataFrame:
    ddl, columns = _layout(name)
    if not paths:
        return spark.createDataFrame([], ddl).select(columns)
    return (spark.read.schema(ddl).option("basePath", table_path(root, name))
            .parquet(*paths).select(columns))


def _read(spark: SparkSession, root: str, name: str, leaves: list[Leaf]) -> DataFrame:
    """Exactly the days of ``leaves``: no other folder is listed."""
    path = table_path(root, name)
    if name not in PARTITIONED:
        return _from_paths(spark, root, name, sorted({f"{path}/{x.folder}" for x in leaves}))
    days = sorted({x.day for x in leaves if x.day is not None})
    df = _from_paths(spark, root, name, sorted(
        f"{path}/{x.folder}/{PARTITION_COLUMN}={NO_DAY if x.day is None else x.day}" for x in leaves))
    if not leaves:
        return df
    # implied by the folders; says in the plan which days are read
    day = F.col(PARTITION_COLUMN)
    span = (day >= F.lit(days[0])) & (day <= F.lit(days[-1])) if days else F.lit(False)
    return df.where(span | day.isNull() if any(x.day is None for x in leaves) else span)


def read_base(spark: SparkSession, root: str, run: int, only: bool = False) -> DataFrame:
    """Bronze rows that arrived up to ``run``, or in it ``only``."""
    name = "events_base"
    ddl = S.TABLE_DDL[name] + f", {RUN_COLUMN} int, {PARTITION_COLUMN} date"
    df = spark.read.schema(ddl).parquet(table_path(root, name))
    at = F.col(RUN_COLUMN)
    return df.where(at == run if only else at <= run) \
        .select(*S.TABLE_COLUMNS[name], PARTITION_COLUMN)


def read_table(spark: SparkSession, root: str, name: str, upto: int | None = None) -> DataFrame:
    """A stored table in its declared column order and types (plus the
    partition day for partitioned tables), as of run ``upto`` (default: the
    last completed one)."""
    known = summary(spark, root, upto)
    if upto is None:
        upto = known.run
    if name == "events_base":
        return read_base(spark, root, upto)
    path = table_path(root, name)
    folders = {x.folder: x.run for x in known.of(name)}
    folders |= {f"run={n}": n for n in _pending(spark, root, name, known.run, upto)}
    if name in SNAPSHOT and folders:
        newest = max(folders, key=folders.get)
        return _from_paths(spark, root, name, [f"{path}/{newest}"])
    return _from_paths(spark, root, name, [f"{path}/{f}" for f in sorted(folders)])


def read_run(spark: SparkSession, root: str, name: str, run: int) -> DataFrame:
    """What ``run`` alone wrote, of a run under way."""
    ddl, columns = _layout(name)
    return spark.read.schema(ddl).parquet(f"{table_path(root, name)}/run={run}").select(columns)


def read_leaves(spark: SparkSession, root: str, known: Summary, name: str,
                at: list[tuple[int, date | None]]) -> DataFrame:
    """The folders and days of a table that hold rows of any (run, day) in ``at``."""
    wanted = [x for x in known.of(name) if any(
        x.first_run <= run <= x.run and (name not in PARTITIONED or x.day == day) for run, day in at)]
    return _read(spark, root, name, wanted)


def read_since(spark: SparkSession, root: str, known: Summary, name: str, day: date | None,
               dayless: bool = False) -> DataFrame:
    """The days of a table from ``day`` on (and rows without one, if ``dayless``)."""
    return _read(spark, root, name, [x for x in known.of(name) if (
        dayless if x.day is None else day is not None and x.day >= day)])


def mark_row(spark: SparkSession, known: Summary, name: str) -> DataFrame:
    """A table's high-water mark from the summary, as the one row that has it."""
    return spark.createDataFrame([(known.high(name),)], f"{STAMP_COLUMN} timestamp_ntz")


def _ordered(df: DataFrame, name: str) -> DataFrame:
    keys = ([PARTITION_COLUMN] if name in PARTITIONED else []) + WRITE_ORDER.get(name, [])
    return df.sortWithinPartitions(*keys) if keys else df


def _write(df: DataFrame, root: str, name: str, folder: str, ranged: bool = False) -> None:
    """``ranged``: files hold ranges of the write order inside a day, so that the statistics of
    row groups cut a look-up to few files. Rows are sampled for it, so they should be stored."""
    df = df.select(S.TABLE_COLUMNS[name])
    path = f"{table_path(root, name)}/{folder}"
    if name not in PARTITIONED:
        _ordered(df, name).write.mode("overwrite").parquet(path)
        return
    # One shuffle by the partition column so each task writes few partitions
    # (else every task opens a file in every day); AQE splits a day too large
    # for one task and merges small ones.
    df = with_partition_column(df)
    df = df.repartitionByRange(PARTITION_COLUMN, *WRITE_ORDER.get(name, [])) if ranged \
        else df.hint("rebalance", PARTITION_COLUMN)
    _ordered(df, name).write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(path)


def write_table(df: DataFrame, root: str, name: str, run: int) -> None:
    """Write what ``run`` adds to a table (or, for a snapshot table, its new
    state), in place of whatever an earlier attempt left."""
    _write(df, root, name, f"run={run}")

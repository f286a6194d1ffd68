"""The scheduled pipeline over stored tables.

``initial_build``: load every landed file, then build bronze (stream),
silver and gold from scratch. ``run_increment``: the chained refresh -- load
new files, append their bronze rows, and only if there are any, refresh
silver (fact, pages, device merge, in that order) and then gold
(``all_events``, then ``session_journey``).

Runs are numbered (``plans.store``). Bronze rows carry the run in which they
arrived; silver and gold of run n read the tables of runs before n and write
folders of run n; the run is recorded when gold is done. What a refresh reads
follows the delivery, not the history: marks come from the summary of the last
run, session windows go on from the sessions' state (``operators.continued``),
and older days are read only where a filter of their keys is hit
(``operators.keyfilter``). A run that failed is
therefore done again by the next call under the same number: what it had loaded
is still its input, whether or not new files came and whatever the load stamp,
and what it had written is replaced. The layers can also be run one by one
(``refresh_silver``, ``refresh_gold``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators import continued, gold, keyfilter, marks, merge, silver
from clickmart.sources.raw import archived_files, audit_of, list_files
from clickmart.plans import pipeline as P
from clickmart.plans import store
from clickmart.plans.store import PARTITION_COLUMN, RUN_COLUMN, read_table, table_path, write_table
from clickmart.operators.sessions import session_key
from clickmart.session import scratch_path
from clickmart.streaming import feed
from clickmart.streaming.ingest import (ingest_files, landing_state, only_if_new, raw_to_base,
                                        sink_state)

RAW = "events_raw"
FILE_COUNTS = "raw_file_counts"
DEVICE_STATE = "device_state"


def stamp(load_ts=None) -> str:
    """The run's load stamp: given, or the driver's clock (UTC, no zone), one
    value for all its rows."""
    return str(load_ts) if load_ts is not None else datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def _with_through(state: DataFrame, load_ts) -> DataFrame:
    return state.select("device_id", "best",
                        F.lit(str(load_ts)).cast("timestamp_ntz").alias("through_load_ts"))


def _checkpoint(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_checkpoints/{name}"


def pending_run(spark: SparkSession, root: str) -> int:
    """The run under way: the one after the last completed."""
    return store.last_run(spark, root) + 1


def load_bronze(spark: SparkSession, root: str, landing: str, load_ts=None,
                max_files_per_trigger: int | None = None,
                archive: str | None = None) -> dict[str, int]:
    """Files -> raw -> bronze, each exactly once. ``max_files_per_trigger``
    cuts a large backlog of files into several micro-batches; loaded files are
    moved to the folder ``archive``, if there is one. Neither query is started
    while its source is as the last run left it."""
    run = pending_run(spark, root)
    raw, ingest, to_base = table_path(root, RAW), _checkpoint(root, "ingest"), _checkpoint(root, "raw_to_base")

    def layout(df: DataFrame) -> DataFrame:
        # one shuffle by day, or every task would open a file in every day
        return (store.with_partition_column(df).withColumn(RUN_COLUMN, F.lit(run))
                .hint("rebalance", PARTITION_COLUMN))

    n_raw = only_if_new(spark, ingest, landing_state(spark, landing), lambda: ingest_files(
        spark, landing, raw, ingest, max_files_per_trigger, archive))
    n_base = only_if_new(spark, to_base, sink_state(spark, raw), lambda: raw_to_base(
        spark, raw, table_path(root, P.BASE), to_base, load_ts,
        layout=layout, partition_by=[RUN_COLUMN, PARTITION_COLUMN]))
    return {"raw_rows": n_raw, "base_rows": n_base}


def initial_build(spark: SparkSession, root: str, landing: str, load_ts=None,
                  max_files_per_trigger: int | None = None,
                  archive: str | None = None) -> dict[str, int]:
    load_ts = stamp(load_ts)
    counts = load_bronze(spark, root, landing, load_ts, max_files_per_trigger, archive)
    build_silver(spark, root, load_ts)
    build_gold(spark, root)
    return counts


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of steps that do not depend on one another, run at once: their jobs share the
    cluster. All have ended when the first error, if any, is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def build_silver(spark: SparkSession, root: str, load_ts=None) -> None:
    load_ts = stamp(load_ts)
    run = pending_run(spark, root)
    base = store.read_base(spark, root, run)

    def devices():
        write_table(_with_through(silver.device_candidates(base), load_ts), root, DEVICE_STATE, run)
        state = read_table(spark, root, DEVICE_STATE, run)
        write_table(silver.profiles(state, load_ts), root, P.DEVICES, run)

    together(spark, lambda: _write_fact(spark, root, run, silver.fact(base, load_ts)),
             lambda: _write_pages(spark, root, run, silver.pages(base, load_ts)),
             lambda: _write_late(spark, root, run, base, None), devices)


def _write_fact(spark: SparkSession, root: str, run: int, rows: DataFrame) -> None:
    write_table(rows, root, P.FACT, run)
    _write_keys(spark, root, run, P.FACT, S.FACT_KEYS)


def _write_pages(spark: SparkSession, root: str, run: int, rows: DataFrame) -> None:
    write_table(rows, root, P.PAGES, run)
    _write_keys(spark, root, run, P.PAGES, S.PAGE_KEYS)


def _write_keys(spark: SparkSession, root: str, run: int, name: str, keys: str) -> None:
    """Filters of the event ids that the days of this run's rows hold."""
    rows = store.read_run(spark, root, name, run)
    write_table(keyfilter.filters(rows, F.col("event_uuid"), F.col(PARTITION_COLUMN), run),
                root, keys, run)


def _write_late(spark: SparkSession, root: str, run: int, rows: DataFrame, mark: Column | None) -> None:
    """Bronze rows of this run that its fact rows do not hold, kept for ``late_report``. Rows
    without an event id are kept too, as no fact row can be told to be theirs."""
    late = F.col("event_uuid").isNull()
    if mark is not None:
        late = late | ~F.coalesce(F.col(marks.MARK_COLUMN) > mark, F.lit(False))
    write_table(rows.where(late), root, S.LATE, run)


def _write_state_keys(root: str, run: int, windowed: DataFrame) -> None:
    """Filter of the sessions that this run's state has rows of."""
    write_table(keyfilter.filters(windowed, session_key(), F.lit(None).cast("date"), run),
                root, S.STATE_KEYS, run)


def build_gold(spark: SparkSession, root: str) -> None:
    run = pending_run(spark, root)
    built = {n: _of_run(spark, root, n, run) for n in (P.FACT, P.PAGES, P.DEVICES)}

    def events():
        write_table(gold.all_events(built[P.FACT], built[P.PAGES], built[P.DEVICES]),
                    root, P.ALL_EVENTS, run)
        windowed = store.read_run(spark, root, P.ALL_EVENTS, run)
        write_table(continued.state_of(windowed, run), root, S.SESSION_STATE, run)
        _write_state_keys(root, run, windowed)

    together(spark, events, lambda: write_table(
        gold.session_journey(built[P.FACT], built[P.PAGES], built[P.DEVICES]), root, P.JOURNEY, run))
    store.complete(spark, root, run, build=True)


def _of_run(spark: SparkSession, root: str, name: str, run: int) -> DataFrame:
    """What ``run`` alone wrote; an error names the layer that is missing."""
    if not store.has_run(spark, root, name, run):
        raise RuntimeError(f"{name} of run {run} is not finished: run the silver layer first")
    return store.read_run(spark, root, name, run)


def _built(spark: SparkSession, root: str) -> int:
    """The pending run; there must be a full build before it."""
    run = pending_run(spark, root)
    if run == 0:
        raise RuntimeError("nothing is built here yet: run the full build first")
    return run


def refresh_silver(spark: SparkSession, root: str, load_ts=None) -> None:
    """Fact and pages appends as in ``pipeline.silver_step``, their marks taken from the
    summary; the device merge reads only the bronze rows of this run and the
    device-sized state (see ``silver.advance_device_state``) instead of all history."""
    load_ts = stamp(load_ts)
    run = _built(spark, root)
    known = store.summary(spark, root)
    base = store.read_base(spark, root, run)
    new_rows = store.read_base(spark, root, run, only=True)

    def appended(increment, name):
        return increment(base, store.mark_row(spark, known, name), load_ts)

    def late():
        mark = marks.mark_of(store.mark_row(spark, known, P.FACT), S.FACT_DEFAULT_MARK)
        _write_late(spark, root, run, new_rows, mark)

    def devices():
        old_state = read_table(spark, root, DEVICE_STATE, run - 1)
        write_table(_with_through(silver.advance_device_state(old_state, new_rows), load_ts),
                    root, DEVICE_STATE, run)
        source = silver.changed_device_source(read_table(spark, root, DEVICE_STATE, run), new_rows,
                                              load_ts)
        write_table(merge.merge_devices(read_table(spark, root, P.DEVICES, run - 1), source),
                    root, P.DEVICES, run)

    together(spark, lambda: _write_fact(spark, root, run, appended(silver.fact_increment, P.FACT)),
             lambda: _write_pages(spark, root, run, appended(silver.pages_increment, P.PAGES)),
             late, devices)


class GoldInputs:
    """What a gold refresh reads: the delivery, and of history only what it needs.

    * ``states``: where the sessions of the new rows stand, from the runs whose
      filter holds them;
    * ``shifted``: sessions with an older event that this run brought a page row for;
    * ``history``: the fact's days from the first one on of sessions that must be
      windowed again;
    * ``pages_of``: page rows of this run, and of the older days whose filter
      holds some of the events;
    * ``journey_rows``: rows above the journey's own mark.

    The filters are asked for all of the delivery at once, when this is made.
    """

    def __init__(self, spark: SparkSession, root: str, run: int):
        self.spark, self.root, self.run = spark, root, run
        self.known = store.summary(spark, root, run - 1)
        self.fact, self.pages, self.devices = (
            _of_run(spark, root, n, run) for n in (P.FACT, P.PAGES, P.DEVICES))
        self.keys = self.fact.select(session_key().alias("key"))
        high = self.known.high(P.JOURNEY) or datetime.fromisoformat(S.GOLD_DEFAULT_MARK)
        self.journey_mark = F.lit(str(high)).cast("timestamp_ntz")
        # the journey's mark may be lower than the fact's: older rows above it count again
        self.journey_old = marks.above_mark(
            store.read_since(spark, root, self.known, P.FACT, high.date()), self.journey_mark)
        new_pages = self.pages.select(F.col("event_uuid").alias("p_uuid"))
        self.shifted_at, self.state_at, self.page_at, self.journey_at = together(
            spark,
            lambda: self._at(S.FACT_KEYS, new_pages, "p_uuid"),
            lambda: self._at(S.STATE_KEYS, self.keys, "key"),
            lambda: self._at(S.PAGE_KEYS, self.fact, "event_uuid"),
            lambda: self._at(S.PAGE_KEYS, self.journey_old, "event_uuid"))

    def _at(self, keys_name: str, keys: DataFrame, key: str) -> list:
        """Runs and days before this run that may hold some of ``keys``."""
        filters = store.read_leaves(self.spark, self.root, self.known, keys_name,
                                    [(x.run, None) for x in self.known.of(keys_name)])
        return keyfilter.hits(filters, keys, key)

    def _older(self, name: str, at: list) -> DataFrame:
        return store.read_leaves(self.spark, self.root, self.known, name, at)

    def pages_of(self, history: DataFrame | None) -> DataFrame:
        more = [] if history is None else self._at(S.PAGE_KEYS, history, "event_uuid")
        return self.pages.unionByName(self._older(P.PAGES, [*self.page_at, *more]))

    def shifted(self) -> DataFrame | None:
        """Keys of the shifted sessions; None without a trace of any."""
        if not self.shifted_at:
            return None
        ids = self.pages.select(F.col("event_uuid").alias("p_uuid"))
        old = self._older(P.FACT, self.shifted_at)
        return old.join(ids, old["event_uuid"] == ids["p_uuid"], "left_semi") \
            .select(session_key().alias("key")).distinct()

    def states(self, more: DataFrame | None) -> DataFrame:
        """The newest state of the sessions of the new rows, and of ``more`` keys."""
        keys, at = self.keys, self.state_at
        if more is not None:
            keys, at = keys.unionByName(more), [*at, *self._at(S.STATE_KEYS, more, "key")]
        keys = keys.distinct()
        old = self._older(S.SESSION_STATE, at).withColumn("s_key", session_key())
        return continued.newest(old.join(keys, old["s_key"] == keys["key"], "left_semi").drop("s_key"))

    def all_sessions(self) -> DataFrame:
        """The state of every session (to window all of them again)."""
        return continued.newest(self._older(
            S.SESSION_STATE, [(x.run, None) for x in self.known.of(S.SESSION_STATE)]))

    def history(self, disturbed: DataFrame) -> DataFrame | None:
        """All older fact rows of the disturbed sessions; None if there is none."""
        n, first, dayless = disturbed.agg(
            F.count(F.lit(1)), F.min("first_day"), F.bool_or("dayless")).first()
        if n == 0:
            return None
        old = store.read_since(self.spark, self.root, self.known, P.FACT, first, dayless) \
            .withColumn("h_key", session_key())
        return old.join(disturbed, old["h_key"] == disturbed["key"], "left_semi").drop("h_key")

    def journey(self) -> DataFrame:
        rows = marks.above_mark(self.fact, self.journey_mark).unionByName(self.journey_old)
        pages = self.pages.unionByName(self._older(P.PAGES, [*self.page_at, *self.journey_at]))
        return gold.session_journey(rows, pages, self.devices)


def windowed_rows(inputs: GoldInputs, prune: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of this run, and all rows of disturbed sessions, with their window
    values over the whole fact; and the state of all these sessions after them.
    Both are read from stored rows."""
    spark, run = inputs.spark, inputs.run
    scratch = scratch_path(spark, "gold")
    shifted = inputs.shifted()
    if shifted is not None:
        shifted = _kept(shifted, f"{scratch}/shifted")
    state = _kept(inputs.states(shifted) if prune else inputs.all_sessions(), f"{scratch}/state")
    disturbed = continued.disturbed(state, inputs.fact, shifted) if prune \
        else state.select("key", "first_day", "dayless")
    history = inputs.history(disturbed)
    rows, on = inputs.fact, state
    if history is not None:
        rows = rows.unionByName(history)
        on = state.join(disturbed.select("key"), "key", "left_anti")
    enriched = gold.enrich(rows, inputs.pages_of(history), inputs.devices)
    windowed = _kept(continued.go_on(
        gold.with_session_windows(enriched, rows.select("session_id")), on), f"{scratch}/windowed")
    return windowed, continued.merged_state(continued.state_of(windowed, run), on)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_gold(spark: SparkSession, root: str, prune: bool = True) -> None:
    run = _built(spark, root)
    inputs = GoldInputs(spark, root, run)

    def events():
        windowed, state = windowed_rows(inputs, prune)
        mark = marks.mark_of(store.mark_row(spark, inputs.known, P.ALL_EVENTS), S.GOLD_DEFAULT_MARK)
        together(spark,
                 lambda: write_table(gold.derive(marks.above_mark(windowed, mark)),
                                     root, P.ALL_EVENTS, run),
                 lambda: write_table(state, root, S.SESSION_STATE, run),
                 lambda: _write_state_keys(root, run, windowed))

    together(spark, events, lambda: write_table(inputs.journey(), root, P.JOURNEY, run))
    store.complete(spark, root, run)


def run_increment(spark: SparkSession, root: str, landing: str, load_ts=None,
                  prune: bool = True, max_files_per_trigger: int | None = None,
                  archive: str | None = None) -> dict[str, int]:
    load_ts = stamp(load_ts)
    run = _built(spark, root)
    counts = load_bronze(spark, root, landing, load_ts, max_files_per_trigger, archive)
    if not store.run_has_bronze(spark, root, run):  # nothing new, nothing left unfinished
        return {**counts, "refreshed": 0}
    refresh_silver(spark, root, load_ts)
    refresh_gold(spark, root, prune)
    return {**counts, "refreshed": 1}


def late_report(spark: SparkSession, root: str) -> DataFrame:
    """Bronze rows that never reached the fact (late or hour-less files): what the runs
    kept back, less the events that a later file brought again. Of the fact, only days
    whose filter holds one of them are read."""
    late = read_table(spark, root, S.LATE)
    known = store.summary(spark, root)
    at = keyfilter.hits(read_table(spark, root, S.FACT_KEYS), late, "event_uuid")
    return marks.late_rows(late, store.read_leaves(spark, root, known, P.FACT, at))


def landing_audit(spark: SparkSession, root: str, landing: str,
                  archive: str | None = None) -> DataFrame:
    """Every landed file against the raw table: rows loaded per file, files
    never loaded (``n_rows`` 0), loaded names no longer listed. Files in the
    ``archive`` count as listed where they landed. Rows per file are kept from
    audit to audit, so of the raw table only what came since is read."""
    raw, counts = table_path(root, RAW), table_path(root, FILE_COUNTS)
    checkpoint = _checkpoint(root, "audit")
    only_if_new(spark, checkpoint, sink_state(spark, raw),
                lambda: feed.count_files(spark, raw, counts, checkpoint))
    listed = list_files(spark, landing)
    if archive:
        listed = listed.unionByName(archived_files(spark, archive)).dropDuplicates(["filename"])
    return audit_of(feed.counted_files(spark, counts), listed)

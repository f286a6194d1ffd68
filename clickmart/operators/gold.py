"""silver -> gold: enriched event table and per-session journey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.timefn import whole_second_diff
from clickmart.operators import sessions
from clickmart.operators.keys import join_spreading_nulls
from clickmart.operators.marks import PARTITION_COLUMN, above_mark, mark_of


def enrich(fct: DataFrame, pages: DataFrame, devices: DataFrame) -> DataFrame:
    """Fact left-joined to its page row (by ``event_uuid``) and to its device
    profile (by ``device_id``). An event present k times in both fact and
    pages yields k*k rows, as the plain join does. NULL keys match nothing
    and are spread rather than sent to one partition (``keys``)."""
    p = pages.select(F.col("event_uuid").alias("p_event_uuid"), "page_url", "page_counter",
                     "page_title", "parent_page_title", "element_text", "element_tag",
                     "element_url")
    d = devices.select(F.col("device_id").alias("d_device_id"), "device_type", "platform")
    e = fct.select("event_uuid", "session_id", "device_id", "event_type", "event_time",
                   "extract_timestamp")
    with_page = join_spreading_nulls(e, p, "event_uuid", "p_event_uuid",
                                     salt=["session_id", "event_time", "device_id"])
    with_device = join_spreading_nulls(with_page, d, "device_id", "d_device_id",
                                       salt=["event_uuid", "session_id", "event_time"])
    return with_device.drop("p_event_uuid", "d_device_id")


def with_session_windows(enriched: DataFrame, keys: DataFrame | None = None,
                         max_rows: int | None = None) -> DataFrame:
    """Next event time, previous type and page, position in the session.
    All four share one window spec (one shuffle, one sort); hot sessions are
    cut into chunks first (``operators.sessions``)."""
    return sessions.with_session_windows(enriched, keys, max_rows)


def event_duration() -> Column:
    """Whole seconds to the next event of the session, as fixed point with
    one decimal; NULL for the last event."""
    duration = whole_second_diff(F.col("event_time"), F.col("next_event_time"))
    return duration.cast("decimal(21,1)").alias("event_duration_s")


def derive(windowed: DataFrame) -> DataFrame:
    """Duration to the next event and the two repeat flags (NULL -> FALSE)."""
    same_page = F.col("page_url") == F.col("previous_page_url")
    repeated = (F.col("event_type") == F.col("previous_event_type")) & same_page
    click_err = (F.col("previous_event_type") == F.lit(S.ELEMENT_CLICKED)) & same_page
    return windowed.select(
        "event_uuid", "session_id", "device_id", "device_type", "platform",
        "event_type", "event_time", event_duration(),
        "event_counter", "page_url", "page_counter", "page_title",
        "parent_page_title", "element_text", "element_tag", "element_url",
        F.when(repeated, True).otherwise(False).alias("previous_event_repeated"),
        F.when(click_err, True).otherwise(False).alias("click_error"),
        "extract_timestamp",
    )


def all_events(fct: DataFrame, pages: DataFrame, devices: DataFrame,
               max_rows: int | None = None) -> DataFrame:
    """``all_events`` full build."""
    keys = fct.select("session_id")
    return derive(with_session_windows(enrich(fct, pages, devices), keys, max_rows))


def touched_sessions(fct: DataFrame, mark: Column) -> DataFrame:
    """Fact rows of every session (NULL included) having a row above the mark.

    Windows partition by session, so rows of untouched sessions cannot change
    any window value of a row above the mark; dropping them first is exact.
    On a day-partitioned fact, a narrow scan (session and day only) first
    finds the earliest day of any touched session, and the wide scan reads
    only days from there on (and the day-less partition): exact, and an
    increment no longer reads the whole history.
    """
    touched = above_mark(fct, mark).select(F.col("session_id").alias("t_session_id")).distinct()

    def rows_of(df: DataFrame) -> DataFrame:
        return df.join(touched, df["session_id"].eqNullSafe(touched["t_session_id"]), "left_semi")

    if PARTITION_COLUMN in fct.columns:
        day = F.col(PARTITION_COLUMN)
        first_day = rows_of(fct.select("session_id", PARTITION_COLUMN)).select(
            F.min(day).alias("first_day")).scalar()
        fct = fct.where((day >= first_day) | day.isNull())
    return rows_of(fct)


def pages_for(pages: DataFrame, fct_rows: DataFrame) -> DataFrame:
    """On a day-partitioned page table, only the days that can hold a page
    row of ``fct_rows``: a narrow scan (uuid, day) finds the earliest day of
    any matching page row, the wide scan then skips earlier days. Exact:
    every matching row is on that day or later (or has no day)."""
    if PARTITION_COLUMN not in pages.columns:
        return pages
    day = F.col(PARTITION_COLUMN)
    keys = fct_rows.select(F.col("event_uuid").alias("k_uuid"))
    narrow = pages.select("event_uuid", PARTITION_COLUMN)
    first_day = narrow.join(keys, narrow["event_uuid"] == keys["k_uuid"], "left_semi").select(
        F.min(day).alias("first_day")).scalar()
    return pages.where((day >= first_day) | day.isNull())


def all_events_increment(fct: DataFrame, pages: DataFrame, devices: DataFrame,
                         target: DataFrame, prune: bool = True) -> DataFrame:
    """Rows to append to ``all_events``: the full computation over the whole
    fact, then kept when above the target's mark (default 1990-01-01). The
    filter runs after the windows, so the first new event of a session still
    sees its predecessor from earlier loads; the last old event keeps its
    NULL duration (append only).

    ``prune`` first restricts the fact to sessions touched by the increment;
    the output is the same, the window sees far fewer rows.
    """
    mark = mark_of(target, default=S.GOLD_DEFAULT_MARK)
    if not prune:
        return above_mark(all_events(fct, pages, devices), mark)
    source = touched_sessions(fct, mark)
    return above_mark(all_events(source, pages_for(pages, source), devices), mark)


def page_path(title: Column) -> Column:
    """Page titles of a session joined by ', ' in session order (time, NULL
    last, then uuid). NULL titles are skipped; all NULL gives ''."""
    t = F.col("event_time")
    u = F.col("event_uuid")
    entries = F.collect_list(F.struct(t.isNull().alias("k0"), t.alias("k1"), u.isNull().alias("k2"),
                                      u.alias("k3"), title.alias("title")))
    return F.array_join(F.transform(F.array_sort(entries), lambda x: x["title"]),
                        S.PAGE_PATH_SEPARATOR)


def page_view_counts(fct: DataFrame, pages: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Per session: ordered page path and number of page-view events (every
    view counts, with or without a page row).

    A hot session (more views than one task should gather, see
    ``operators.sessions``) is built in two levels: an ordered path per chunk
    of its rows, then the chunk paths joined in chunk order (empty ones skipped).
    The path itself stays one value per session, as defined.
    """
    views = fct.where(F.col("event_type") == F.lit(S.PAGE_VIEWED)).select(
        "event_uuid", "session_id", "event_time")
    p = pages.select(F.col("event_uuid").alias("p_event_uuid"), "page_title")
    joined = join_spreading_nulls(views, p, "event_uuid", "p_event_uuid",
                                  salt=["session_id", "event_time"]).drop("p_event_uuid")
    if max_rows is None:
        max_rows = sessions.configured_max_rows(fct)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.groupBy("session_id").agg(
            page_path(F.col("page_title")).alias("page_path"),
            F.count(F.lit(1)).alias("total_pages_viewed"))

    hot, n_hot_rows = sessions.find_hot(views, max_rows)
    if n_hot_rows == 0:
        return plain(joined)
    rest, chunked = sessions.split_hot(joined, hot, n_hot_rows, max_rows)
    parts = chunked.groupBy("_sk", "session_id", "_chunk").agg(
        page_path(F.col("page_title")).alias("_part"), F.count(F.lit(1)).alias("_n"))
    ordered = F.array_sort(F.collect_list(F.struct(
        F.col("_chunk").alias("c"), F.nullif(F.col("_part"), F.lit("")).alias("part"))))
    return plain(rest).unionByName(parts.groupBy("_sk", "session_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["part"]), S.PAGE_PATH_SEPARATOR).alias("page_path"),
        F.sum("_n").alias("total_pages_viewed"),
    ).drop("_sk"))


def all_event_counts(fct: DataFrame, devices: DataFrame) -> DataFrame:
    """Per session and *dimension* device: counts, first/last time, span in
    whole seconds, latest stamp. Unmatched devices group under NULL.

    The fact is first reduced to one row per (session, fact device) -- count,
    min, max compose -- so the device join sees that many rows instead of one
    per event; then the rows are regrouped by the dimension's device."""
    per_device = fct.groupBy("session_id", "device_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_time").alias("t_min"),
        F.max("event_time").alias("t_max"),
        F.max("extract_timestamp").alias("ext_max"),
    )
    d = devices.select(F.col("device_id").alias("d_device_id"), "device_type", "platform")
    # Partition the (small, pre-aggregated) rows by session: the regrouping
    # below and the join with the page-view counts (also by session) then
    # need no further shuffle.
    joined = join_spreading_nulls(per_device, d, "device_id", "d_device_id",
                                  salt=["session_id"]).repartition("session_id")
    agg = joined.groupBy("session_id", "d_device_id", "device_type", "platform").agg(
        F.sum("n").alias("total_events"),
        F.min("t_min").alias("session_start_time"),
        F.max("t_max").alias("session_end_time"),
        F.max("ext_max").alias("extract_timestamp"),
    )
    return agg.select(
        "session_id", F.col("d_device_id").alias("device_id"), "device_type", "platform",
        "total_events", "session_start_time", "session_end_time",
        whole_second_diff(F.col("session_start_time"), F.col("session_end_time")).alias("event_duration_s"),
        "extract_timestamp",
    )


def session_journey(fct: DataFrame, pages: DataFrame, devices: DataFrame) -> DataFrame:
    """``session_journey``: totals joined (inner) to page-view counts, so
    sessions without a page view, or with a NULL id, drop out."""
    counts = all_event_counts(fct, devices)
    views = page_view_counts(fct, pages)
    return counts.join(views, "session_id", "inner").select(S.SESSION_JOURNEY_COLUMNS)


def session_journey_increment(fct: DataFrame, pages: DataFrame, devices: DataFrame,
                              target: DataFrame) -> DataFrame:
    """Rows to append to ``session_journey``: the same computation over fact
    rows above the journey's own mark (default 1990-01-01). Events are
    filtered before grouping, so a session spanning two loads gets two
    partial rows."""
    mark = mark_of(target, default=S.GOLD_DEFAULT_MARK)
    new_rows = above_mark(fct, mark)
    return session_journey(new_rows, pages_for(pages, new_rows), devices)

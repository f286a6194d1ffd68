"""Session windows that go on from where the last run left each session.

``session_state`` has one row per session and run that touched it: how many
rows the session has (``n_rows``), the first day with one of them, and its last
row in window order. New rows that sort after it need no older row: their
position is the state's count plus their own, and the first of them sees the
state's last row as its predecessor. Only a session whose new rows sort before
or level with its last row, or whose old rows have got further page rows, is
windowed again over all its rows (``disturbed``).

The values equal the windows over the whole fact (``operators.gold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators.marks import MARK_COLUMN
from clickmart.operators.sessions import session_key


def place(time: str = "event_time", uuid: str = "event_uuid") -> list[Column]:
    """A row's place in its session; structs of these compare as the window orders."""
    t, u = F.col(time), F.col(uuid)
    return [t.isNull().alias("no_time"), t.alias("event_time"),
            u.isNull().alias("no_uuid"), u.alias("event_uuid")]


def state_of(windowed: DataFrame, run: int) -> DataFrame:
    """The state after ``windowed`` (rows with ``event_counter``): a session's greatest counter
    is its number of rows."""
    day = F.to_date(MARK_COLUMN)
    last = F.struct(*place(), "event_type", "page_url")
    return windowed.groupBy("session_id").agg(
        F.max("event_counter").alias("n_rows"), F.min(day).alias("first_day"),
        F.bool_or(day.isNull()).alias("dayless"),
        F.max_by(last, "event_counter").alias("last"),
        F.lit(run).alias("at_run")).select(S.TABLE_COLUMNS[S.SESSION_STATE])


def newest(states: DataFrame) -> DataFrame:
    """The newest state of each session, with its ``key``."""
    columns = S.TABLE_COLUMNS[S.SESSION_STATE]
    return states.groupBy(session_key().alias("key")).agg(
        F.max_by(F.struct(*columns), "at_run").alias("s")).select("key", "s.*")


def disturbed(state: DataFrame, new_rows: DataFrame, shifted: DataFrame | None) -> DataFrame:
    """(key, first_day, dayless) of sessions that must be windowed again.

    ``shifted``: keys of sessions whose old rows join to more page rows than before.
    """
    first = new_rows.groupBy(session_key().alias("n_key")).agg(
        F.min(F.struct(*place())).alias("first_new"))
    last = F.struct(*[F.col(f"last.{c}").alias(c)
                      for c in ("no_time", "event_time", "no_uuid", "event_uuid")])
    out = state.join(first, state["key"] == first["n_key"]) \
        .where(F.col("first_new") <= last).select("key", "first_day", "dayless")
    if shifted is not None:
        more = state.join(shifted.select("key").distinct(), "key", "left_semi") \
            .select("key", "first_day", "dayless")
        out = out.unionByName(more).distinct()
    return out


def go_on(windowed: DataFrame, state: DataFrame) -> DataFrame:
    """``windowed`` over new rows only, moved behind the rows that ``state`` stands for."""
    s = state.select(F.col("key").alias("s_key"), F.col("n_rows").alias("s_rows"),
                     F.col("last.event_type").alias("s_type"), F.col("last.page_url").alias("s_url"))
    x = windowed.withColumn("w_key", session_key())
    j = x.join(s, x["w_key"] == s["s_key"], "left")
    first = (F.col("event_counter") == 1) & F.col("s_key").isNotNull()
    moved = {
        "previous_event_type": F.when(first, F.col("s_type")).otherwise(F.col("previous_event_type")),
        "previous_page_url": F.when(first, F.col("s_url")).otherwise(F.col("previous_page_url")),
        "event_counter": F.col("event_counter") + F.coalesce(F.col("s_rows"), F.lit(0)),
    }
    return j.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in windowed.columns])


def merged_state(after: DataFrame, before: DataFrame) -> DataFrame:
    """``after`` with the days of ``before`` (the state of the sessions that went on)."""
    b = before.select(F.col("key").alias("b_key"), F.col("first_day").alias("b_day"),
                      F.col("dayless").alias("b_dayless"))
    a = after.withColumn("a_key", session_key())
    return a.join(b, a["a_key"] == b["b_key"], "left").select(
        "session_id", "n_rows", F.least("first_day", "b_day").alias("first_day"),
        (F.col("dayless") | F.coalesce(F.col("b_dayless"), F.lit(False))).alias("dayless"),
        "last", "at_run")

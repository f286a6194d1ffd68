"""bronze -> silver: event fact, page dimension, latest device profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.text import page_title, parent_page_title
from clickmart.operators.bronze import load_time
from clickmart.operators.marks import above_mark, mark_of


def fact(base: DataFrame, load_ts=None) -> DataFrame:
    """``fct_all_session_events``."""
    return base.select(*S.FACT_COLUMNS[:-1], load_time(load_ts).alias("load_timestamp"))


def pages(base: DataFrame, load_ts=None) -> DataFrame:
    """``dim_event_pages``: events with a page URL (an empty URL counts),
    with the URL's last two path segments as titles."""
    url = F.col("page_url")
    return base.where(url.isNotNull()).select(
        "event_uuid", "page_url", "page_counter",
        page_title(url).alias("page_title"),
        parent_page_title(url).alias("parent_page_title"),
        "element_text", "element_tag", "element_url", "extract_timestamp",
        load_time(load_ts).alias("load_timestamp"),
    )


def _ordering_struct() -> Column:
    ext = F.col("extract_timestamp")
    return F.struct(
        ext.isNull().alias("k0"), ext.alias("k1"), F.col("event_time").alias("k2"),
        F.col("event_uuid").alias("k3"),
        *[F.col(c) for c in S.DEVICE_PROFILE_COLUMNS],
    )


def device_candidates(base: DataFrame) -> DataFrame:
    """Per ``device_id`` (NULL ids form one group) the winning row as a
    struct ``best``: ordering key first, then the profile, so ``max`` picks
    the latest ``extract_timestamp`` (NULL counts as latest), then the latest
    ``event_time`` (NULL last), the greatest ``event_uuid``, then profile
    values -- a total order. As an aggregate it combines map-side: a device
    holding a large share of all events is one row per task before the
    shuffle (a ranking window would sort all its rows in one task)."""
    return base.groupBy("device_id").agg(F.max(_ordering_struct()).alias("best"))


def profiles(candidates: DataFrame, load_ts=None) -> DataFrame:
    return candidates.select(
        "device_id", *[F.col(f"best.{c}").alias(c) for c in S.DEVICE_PROFILE_COLUMNS],
        load_time(load_ts).alias("load_timestamp"),
    )


def latest_devices(base: DataFrame, load_ts=None) -> DataFrame:
    """``dim_devices``: one profile per ``device_id`` from its latest row."""
    return profiles(device_candidates(base), load_ts)


def advance_device_state(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Winning rows over old and new base rows. Base is append-only, so the
    maximum over all history is the maximum of the old maximum and the new
    rows' maximum: only new rows and the (device-sized) state are read."""
    cand = device_candidates(new_rows)
    return (state.select("device_id", "best").unionByName(cand)
            .groupBy("device_id").agg(F.max("best").alias("best")))


def changed_device_source(state: DataFrame, new_rows: DataFrame, load_ts=None) -> DataFrame:
    """The merge source restricted to devices that can differ from the last
    merge: those with new base rows, plus the NULL device (its row never
    matches, so it is inserted again every run). Re-merging an unchanged
    device's profile is a no-op, so leaving them out changes nothing."""
    ids = new_rows.select(F.col("device_id").alias("c_device_id")).distinct()
    touched = state.join(ids, state["device_id"] == ids["c_device_id"], "left_semi")
    return profiles(touched.unionByName(state.where(F.col("device_id").isNull())), load_ts)


def fact_increment(base: DataFrame, fct_target: DataFrame, load_ts=None) -> DataFrame:
    """Rows to append to the fact: base rows above the fact's mark, which
    defaults to 1900-01-01 when the fact is empty."""
    mark = mark_of(fct_target, default=S.FACT_DEFAULT_MARK)
    return fact(above_mark(base, mark), load_ts)


def pages_increment(base: DataFrame, pages_target: DataFrame, load_ts=None) -> DataFrame:
    """Rows to append to the page dimension: page rows above its mark. There
    is no default: an empty target gives a NULL mark and so no rows."""
    mark = mark_of(pages_target, default=None)
    return pages(above_mark(base, mark), load_ts)

"""The medallion as pure functions over DataFrames.

``full_build`` is the initial build of every table. ``silver_step`` and
``gold_step`` are the incremental refreshes: they take the current tables and
return what the refresh appends (or, for devices, the new snapshot), and
``apply_increment`` chains them the way the refresh task graph does (bronze
rows first, then silver, then gold, each step seeing the previous one's
output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickmart.operators.bronze import bronze
from clickmart.operators.gold import (
    all_events,
    all_events_increment,
    session_journey,
    session_journey_increment,
)
from clickmart.operators.merge import merge_devices
from clickmart.operators.silver import (
    fact,
    fact_increment,
    latest_devices,
    pages,
    pages_increment,
)

BASE = "events_base"
FACT = "fct_all_session_events"
PAGES = "dim_event_pages"
DEVICES = "dim_devices"
ALL_EVENTS = "all_events"
JOURNEY = "session_journey"


def silver_build(base: DataFrame, load_ts=None) -> dict[str, DataFrame]:
    return {
        FACT: fact(base, load_ts),
        PAGES: pages(base, load_ts),
        DEVICES: latest_devices(base, load_ts),
    }


def gold_build(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    f, p, d = silver[FACT], silver[PAGES], silver[DEVICES]
    return {ALL_EVENTS: all_events(f, p, d), JOURNEY: session_journey(f, p, d)}


def full_build(raw: DataFrame, load_ts=None) -> dict[str, DataFrame]:
    """Every table built from the whole raw layer."""
    base = bronze(raw, load_ts)
    silver = silver_build(base, load_ts)
    return {BASE: base, **silver, **gold_build(silver)}


def silver_step(base: DataFrame, tables: dict[str, DataFrame], load_ts=None) -> dict[str, DataFrame]:
    """Fact rows to append, page rows to append, device snapshot after the
    merge. The three statements are independent: each reads ``base`` and
    its own target only."""
    return {
        FACT: fact_increment(base, tables[FACT], load_ts),
        PAGES: pages_increment(base, tables[PAGES], load_ts),
        DEVICES: merge_devices(tables[DEVICES], latest_devices(base, load_ts)),
    }


def gold_step(tables: dict[str, DataFrame], prune: bool = True) -> dict[str, DataFrame]:
    """Rows to append to both gold tables, from silver tables that already
    hold this run's rows."""
    f, p, d = tables[FACT], tables[PAGES], tables[DEVICES]
    return {
        ALL_EVENTS: all_events_increment(f, p, d, tables[ALL_EVENTS], prune=prune),
        JOURNEY: session_journey_increment(f, p, d, tables[JOURNEY]),
    }


def apply_increment(tables: dict[str, DataFrame], new_base_rows: DataFrame,
                    load_ts=None, prune: bool = True) -> dict[str, DataFrame]:
    """All tables after one refresh: bronze rows appended, then silver, then
    gold (append for every table but the device snapshot)."""
    out = dict(tables)
    out[BASE] = tables[BASE].unionByName(new_base_rows)
    silver = silver_step(out[BASE], out, load_ts)
    out[FACT] = out[FACT].unionByName(silver[FACT])
    out[PAGES] = out[PAGES].unionByName(silver[PAGES])
    out[DEVICES] = silver[DEVICES]
    gold = gold_step(out, prune=prune)
    out[ALL_EVENTS] = out[ALL_EVENTS].unionByName(gold[ALL_EVENTS])
    out[JOURNEY] = out[JOURNEY].unionByName(gold[JOURNEY])
    return out

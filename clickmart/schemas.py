"""Table layouts and the fixed values the pipeline's results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must stay exactly as written for results to match the
# pipeline being re-implemented (vendor property names, patterns, literals).
# ---------------------------------------------------------------------------
VENDOR_TAG = "[Amplitude]"
VENDOR_TAG_WITH_BLANK = "[Amplitude] "
PROPERTY_PAGE_URL = "[Amplitude] Page URL"
PROPERTY_PAGE_COUNTER = "[Amplitude] Page Counter"
PROPERTY_ELEMENT_TEXT = "[Amplitude] Element Text"
PROPERTY_ELEMENT_TAG = "[Amplitude] Element Tag"
PROPERTY_ELEMENT_HREF = "[Amplitude] Element Href"
FILE_HOUR_PATTERN = r"\d{4}-\d{2}-\d{2}_\d{1,2}"
FILE_HOUR_FORMAT = "yyyy-MM-dd_H"
PAGE_TITLE_PATTERN = r"/([^/]+)/?$"
PARENT_PAGE_TITLE_PATTERN = r"/([^/]+)/[^/]+/?$"
PAGE_VIEWED = "Page Viewed"
ELEMENT_CLICKED = "Element Clicked"
PAGE_PATH_SEPARATOR = ", "
FACT_DEFAULT_MARK = "1900-01-01 00:00:00"
GOLD_DEFAULT_MARK = "1990-01-01 00:00:00"
# Word delimiters of the title-casing function: white space and these characters.
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("json_data", T.VariantType(), True),
        T.StructField("filename", T.StringType(), True),
    ]
)

BASE_COLUMNS = [
    "event_uuid", "session_id", "device_id", "device_type", "device_family",
    "platform", "os_version", "os_name", "event_type", "event_time", "page_url",
    "page_counter", "element_text", "element_tag", "element_url",
    "extract_timestamp", "load_timestamp",
]

FACT_COLUMNS = [
    "event_uuid", "session_id", "device_id", "event_type", "event_time",
    "extract_timestamp", "load_timestamp",
]

PAGES_COLUMNS = [
    "event_uuid", "page_url", "page_counter", "page_title", "parent_page_title",
    "element_text", "element_tag", "element_url", "extract_timestamp",
    "load_timestamp",
]

DEVICE_PROFILE_COLUMNS = [
    "device_type", "device_family", "platform", "os_version", "os_name",
]

DEVICES_COLUMNS = ["device_id", *DEVICE_PROFILE_COLUMNS, "load_timestamp"]

ALL_EVENTS_COLUMNS = [
    "event_uuid", "session_id", "device_id", "device_type", "platform",
    "event_type", "event_time", "event_duration_s", "event_counter", "page_url",
    "page_counter", "page_title", "parent_page_title", "element_text",
    "element_tag", "element_url", "previous_event_repeated", "click_error",
    "extract_timestamp",
]

SESSION_JOURNEY_COLUMNS = [
    "session_id", "device_id", "device_type", "platform", "page_path",
    "total_events", "total_pages_viewed", "session_start_time",
    "session_end_time", "event_duration_s", "extract_timestamp",
]

TABLE_COLUMNS = {
    "events_base": BASE_COLUMNS,
    "fct_all_session_events": FACT_COLUMNS,
    "dim_event_pages": PAGES_COLUMNS,
    "dim_devices": DEVICES_COLUMNS,
    "all_events": ALL_EVENTS_COLUMNS,
    "session_journey": SESSION_JOURNEY_COLUMNS,
}

# DDL of every stored table (read back with these so a partition column
# keeps its zone-free timestamp type).
_TS = "timestamp_ntz"
TABLE_DDL = {
    "events_base": ", ".join(
        f"{c} {_TS if c in ('event_time', 'extract_timestamp', 'load_timestamp') else 'bigint' if c == 'page_counter' else 'string'}"
        for c in BASE_COLUMNS),
    "fct_all_session_events": ", ".join(
        f"{c} {_TS if c in ('event_time', 'extract_timestamp', 'load_timestamp') else 'string'}"
        for c in FACT_COLUMNS),
    "dim_event_pages": ", ".join(
        f"{c} {_TS if c in ('extract_timestamp', 'load_timestamp') else 'bigint' if c == 'page_counter' else 'string'}"
        for c in PAGES_COLUMNS),
    "dim_devices": ", ".join(f"{c} {_TS if c == 'load_timestamp' else 'string'}" for c in DEVICES_COLUMNS),
    "all_events": (
        "event_uuid string, session_id string, device_id string, device_type string, platform string, "
        "event_type string, event_time timestamp_ntz, event_duration_s decimal(21,1), event_counter bigint, "
        "page_url string, page_counter bigint, page_title string, parent_page_title string, "
        "element_text string, element_tag string, element_url string, previous_event_repeated boolean, "
        "click_error boolean, extract_timestamp timestamp_ntz"),
    "session_journey": (
        "session_id string, device_id string, device_type string, platform string, page_path string, "
        "total_events bigint, total_pages_viewed bigint, session_start_time timestamp_ntz, "
        "session_end_time timestamp_ntz, event_duration_s bigint, extract_timestamp timestamp_ntz"),
}

DEVICE_STATE_COLUMNS = ["device_id", "best", "through_load_ts"]
TABLE_COLUMNS["device_state"] = DEVICE_STATE_COLUMNS
TABLE_DDL["device_state"] = (
    "device_id string, best struct<k0:boolean,k1:timestamp_ntz,k2:timestamp_ntz,k3:string,"
    + ",".join(f"{c}:string" for c in DEVICE_PROFILE_COLUMNS)
    + ">, through_load_ts timestamp_ntz")

# Carried from run to run beside the tables: where each session stands
# (operators.continued) and which keys the folders of a table hold
# (operators.keyfilter).
SESSION_STATE = "session_state"
TABLE_COLUMNS[SESSION_STATE] = ["session_id", "n_rows", "first_day", "dayless", "last", "at_run"]
TABLE_DDL[SESSION_STATE] = (
    "session_id string, n_rows bigint, first_day date, dayless boolean, "
    "last struct<no_time:boolean,event_time:timestamp_ntz,no_uuid:boolean,event_uuid:string,"
    "event_type:string,page_url:string>, at_run int")
FACT_KEYS, PAGE_KEYS, STATE_KEYS = "fct_event_keys", "page_event_keys", "session_state_keys"
for _name in (FACT_KEYS, PAGE_KEYS, STATE_KEYS):
    TABLE_COLUMNS[_name] = ["at_run", "day", "level", "shard", "n_bits", "bits"]
    TABLE_DDL[_name] = ("at_run int, day date, level bigint, shard bigint, n_bits bigint, "
                        "bits binary")

# Bronze rows that a run's fact rows do not hold.
LATE = "late_events"
TABLE_COLUMNS[LATE], TABLE_DDL[LATE] = TABLE_COLUMNS["events_base"], TABLE_DDL["events_base"]

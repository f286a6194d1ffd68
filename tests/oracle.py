"""Independent DuckDB SQL for every registered query.

Written from the pipeline's SQL semantics, not from the Spark code: the raw
events come straight from ``events`` + ``pages`` (FIXTURES.md §2) as typed
columns, then each layer is plain SQL. DuckDB has no word title-casing, so
it is spelled out character by character.
"""

from __future__ import annotations

LOAD_1 = "TIMESTAMP '2026-05-14 09:00:00'"
LOAD_2 = "TIMESTAMP '2026-05-15 09:00:00'"
CUT = "TIMESTAMP '2024-01-18 00:00:00'"
LATE_HOUR = 23

DELIMS = ("' !?@\"^#$&~_,.:;+-*%/|\\[](){}<>' || chr(9) || chr(10) || chr(11) "
          "|| chr(12) || chr(13)")

SRC = """
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, p.url
  FROM events e
  LEFT JOIN pages p ON p.page_id = (e.user_id + day(e.ts) // 3) % (SELECT count(*) FROM pages)
),
src AS (
  SELECT
    'ev-' || CAST(event_id AS VARCHAR) AS event_uuid,
    CAST(user_id AS VARCHAR) || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS session_id,
    CASE WHEN event_id % 101 = 0 THEN NULL
         ELSE 'd' || CAST(user_id + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS device_id,
    'm' || CAST(user_id % 4 AS VARCHAR) AS device_type,
    'f' || CAST(user_id % 7 AS VARCHAR) AS device_family,
    CASE WHEN day(ts) >= 20 AND user_id % 5 = 0 THEN 'Web' ELSE 'iOS' END AS platform,
    '1.' || CAST(day(ts) // 10 AS VARCHAR) AS os_version,
    CASE WHEN user_id % 6 = 0 THEN NULL ELSE 'os' || CAST(user_id % 3 AS VARCHAR) END AS os_name,
    CASE event_type WHEN 'view' THEN '[Amplitude] Page Viewed'
                    WHEN 'click' THEN '[Amplitude] Element Clicked'
                    WHEN 'signup' THEN 'sign_up'
                    WHEN 'error' THEN 'error_raised'
                    ELSE event_type END AS event_type,
    ts AS event_time,
    CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE url END AS page_url,
    CASE WHEN event_type IN ('signup', 'error') OR url IS NULL THEN NULL ELSE event_id % 10 END AS page_counter,
    CASE WHEN event_type = 'click' THEN 't' || CAST(event_id % 5 AS VARCHAR) END AS element_text,
    CASE WHEN event_type = 'click' THEN 'a' END AS element_tag,
    CASE WHEN event_type = 'click' THEN url END AS element_url,
    'data/0_' || strftime(ts, '%Y-%m-%d') || '_' || CAST(hour(ts) AS VARCHAR) || '#0.json' AS filename
  FROM ev
),
src_h AS (
  SELECT *, strptime(NULLIF(regexp_extract(filename, '\\d{4}-\\d{2}-\\d{2}_\\d{1,2}'), ''), '%Y-%m-%d_%H') AS file_ts
  FROM src
)"""


def extract_cte(name: str, src: str, load: str) -> str:
    return f"""
{name} AS (
  SELECT event_uuid, session_id, device_id, device_type, device_family, platform, os_version,
         os_name, event_type, event_time, page_url, CAST(page_counter AS BIGINT) AS page_counter,
         element_text, element_tag, element_url, file_ts AS extract_timestamp,
         {load} AS load_timestamp
  FROM {src}
)"""


def bronze_ctes(name: str, src: str, load: str) -> str:
    return extract_cte(f"{name}_x", src, load) + f""",
{name}_c AS (
  SELECT *, string_split(CASE WHEN contains(event_type, '[Amplitude]') THEN replace(event_type, '[Amplitude] ', '')
                              WHEN contains(event_type, '_') THEN replace(event_type, '_', ' ')
                              ELSE event_type END, '') AS et_chars
  FROM {name}_x
),
{name} AS (
  SELECT event_uuid, session_id, device_id, device_type, device_family, platform, os_version, os_name,
         array_to_string(list_transform(et_chars, lambda c, i:
             CASE WHEN i = 1 OR position(et_chars[i - 1] IN {DELIMS}) > 0 THEN upper(c) ELSE lower(c) END), '')
           AS event_type,
         event_time, page_url, page_counter, element_text, element_tag, element_url,
         extract_timestamp, load_timestamp
  FROM {name}_c
)"""


def fact_cte(name: str, base: str, load: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT event_uuid, session_id, device_id, event_type, event_time, extract_timestamp,
         {load} AS load_timestamp
  FROM {base} WHERE {where}
)"""


def pages_cte(name: str, base: str, load: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT event_uuid, page_url, page_counter,
         NULLIF(regexp_extract(page_url, '/([^/]+)/?$', 1), '') AS page_title,
         NULLIF(regexp_extract(page_url, '/([^/]+)/[^/]+/?$', 1), '') AS parent_page_title,
         element_text, element_tag, element_url, extract_timestamp, {load} AS load_timestamp
  FROM {base} WHERE page_url IS NOT NULL AND {where}
)"""


def devices_cte(name: str, base: str, load: str) -> str:
    return f"""
{name} AS (
  SELECT device_id, device_type, device_family, platform, os_version, os_name, {load} AS load_timestamp
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY device_id
      ORDER BY extract_timestamp DESC NULLS FIRST, event_time DESC NULLS LAST,
               event_uuid DESC NULLS LAST, device_type DESC NULLS LAST,
               device_family DESC NULLS LAST, platform DESC NULLS LAST,
               os_version DESC NULLS LAST, os_name DESC NULLS LAST) AS rn
    FROM {base}
  ) WHERE rn = 1
)"""


def merge_cte(name: str, target: str, source: str) -> str:
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in
                          ("device_type", "device_family", "platform", "os_version", "os_name"))

    def upd(c: str) -> str:
        return f"CASE WHEN s.device_id IS NOT NULL AND ({changed}) THEN s.{c} ELSE t.{c} END AS {c}"

    return f"""
{name} AS (
  SELECT t.device_id, {upd('device_type')}, {upd('device_family')}, t.platform,
         {upd('os_version')}, {upd('os_name')}, t.load_timestamp
  FROM {target} t LEFT JOIN {source} s ON t.device_id = s.device_id
  UNION ALL
  SELECT s.* FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.device_id = s.device_id)
)"""


def windows_cte(name: str, fct: str, pages: str, devices: str) -> str:
    return f"""
{name} AS (
  SELECT e.event_uuid, e.session_id, e.device_id, d.device_type, d.platform, e.event_type, e.event_time,
         p.page_url, p.page_counter, p.page_title, p.parent_page_title, p.element_text, p.element_tag,
         p.element_url,
         lead(e.event_time) OVER w AS next_event_time,
         lag(e.event_type) OVER w AS previous_event_type,
         lag(p.page_url) OVER w AS previous_page_url,
         row_number() OVER w AS event_counter,
         e.extract_timestamp
  FROM {fct} e
  LEFT JOIN {pages} p ON e.event_uuid = p.event_uuid
  LEFT JOIN {devices} d ON e.device_id = d.device_id
  WINDOW w AS (PARTITION BY e.session_id ORDER BY e.event_time ASC NULLS LAST, e.event_uuid ASC NULLS LAST)
)"""


def all_events_ctes(name: str, fct: str, pages: str, devices: str) -> str:
    return windows_cte(f"{name}_w", fct, pages, devices) + f""",
{name} AS (
  SELECT event_uuid, session_id, device_id, device_type, platform, event_type, event_time,
         CAST(date_diff('second', event_time, next_event_time) AS DECIMAL(21,1)) AS event_duration_s,
         event_counter, page_url, page_counter, page_title, parent_page_title, element_text,
         element_tag, element_url,
         CASE WHEN event_type = previous_event_type AND page_url = previous_page_url THEN TRUE ELSE FALSE END
           AS previous_event_repeated,
         CASE WHEN previous_event_type = 'Element Clicked' AND page_url = previous_page_url THEN TRUE ELSE FALSE END
           AS click_error,
         extract_timestamp
  FROM {name}_w
)"""


def page_views_cte(name: str, fct: str, pages: str) -> str:
    return f"""
{name} AS (
  SELECT e.session_id,
         COALESCE(string_agg(p.page_title, ', ' ORDER BY e.event_time ASC NULLS LAST,
                             e.event_uuid ASC NULLS LAST, p.page_title ASC NULLS FIRST), '') AS page_path,
         count(*) AS total_pages_viewed
  FROM {fct} e LEFT JOIN {pages} p ON e.event_uuid = p.event_uuid
  WHERE e.event_type = 'Page Viewed'
  GROUP BY e.session_id
)"""


def journey_ctes(name: str, fct: str, pages: str, devices: str) -> str:
    return page_views_cte(f"{name}_pv", fct, pages) + f""",
{name}_ae AS (
  SELECT e.session_id, d.device_id, d.device_type, d.platform,
         count(*) AS total_events,
         min(e.event_time) AS session_start_time,
         max(e.event_time) AS session_end_time,
         date_diff('second', min(e.event_time), max(e.event_time)) AS event_duration_s,
         max(e.extract_timestamp) AS extract_timestamp
  FROM {fct} e LEFT JOIN {devices} d ON e.device_id = d.device_id
  GROUP BY e.session_id, d.device_id, d.device_type, d.platform
),
{name} AS (
  SELECT e.session_id, e.device_id, e.device_type, e.platform, p.page_path, e.total_events,
         p.total_pages_viewed, e.session_start_time, e.session_end_time, e.event_duration_s,
         e.extract_timestamp
  FROM {name}_ae e JOIN {name}_pv p ON e.session_id = p.session_id
)"""


def full_ctes() -> str:
    return ",".join([
        SRC,
        bronze_ctes("base", "src_h", LOAD_1),
        fact_cte("fct", "base", LOAD_1),
        pages_cte("pg", "base", LOAD_1),
        devices_cte("dev", "base", LOAD_1),
        all_events_ctes("ae", "fct", "pg", "dev"),
        journey_ctes("sj", "fct", "pg", "dev"),
    ])


def two_batch_ctes(late: bool = False) -> str:
    first = f"coalesce(file_ts < {CUT}, FALSE)"
    if late:
        first = f"coalesce(file_ts < {CUT} AND hour(file_ts) <> {LATE_HOUR}, FALSE)"
    return ",".join([
        SRC,
        f"\nsrc1 AS (SELECT * FROM src_h WHERE {first})",
        f"\nsrc2 AS (SELECT * FROM src_h WHERE NOT {first})",
        bronze_ctes("base1", "src1", LOAD_1),
        bronze_ctes("base2", "src2", LOAD_2),
        "\nbase_all AS (SELECT * FROM base1 UNION ALL SELECT * FROM base2)",
        fact_cte("fct1", "base1", LOAD_1),
        pages_cte("pg1", "base1", LOAD_1),
        devices_cte("dev1", "base1", LOAD_1),
        all_events_ctes("ae1", "fct1", "pg1", "dev1"),
        journey_ctes("sj1", "fct1", "pg1", "dev1"),
        fact_cte("fct_inc", "base_all", LOAD_2,
                 "extract_timestamp > (SELECT COALESCE(max(extract_timestamp), TIMESTAMP '1900-01-01') FROM fct1)"),
        pages_cte("pg_inc", "base_all", LOAD_2,
                  "extract_timestamp > (SELECT max(extract_timestamp) FROM pg1)"),
        devices_cte("dev_src", "base_all", LOAD_2),
        merge_cte("dev2", "dev1", "dev_src"),
        "\nfct2 AS (SELECT * FROM fct1 UNION ALL SELECT * FROM fct_inc)",
        "\npg2 AS (SELECT * FROM pg1 UNION ALL SELECT * FROM pg_inc)",
        all_events_ctes("ae_all2", "fct2", "pg2", "dev2"),
        "\nae_inc AS (SELECT * FROM ae_all2 WHERE extract_timestamp > "
        "(SELECT COALESCE(max(extract_timestamp), TIMESTAMP '1990-01-01') FROM ae1))",
        "\nfct2_new AS (SELECT * FROM fct2 WHERE extract_timestamp > "
        "(SELECT COALESCE(max(extract_timestamp), TIMESTAMP '1990-01-01') FROM sj1))",
        journey_ctes("sj_inc", "fct2_new", "pg2", "dev2"),
    ])


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    full = full_ctes()
    two = two_batch_ctes()
    raw_proj = ("SELECT event_uuid, session_id, device_id, "
                "regexp_extract(filename, '\\d{4}-\\d{2}-\\d{2}_\\d{1,2}') AS file_hour FROM src")
    base_cols = ("event_uuid, session_id, device_id, device_type, device_family, platform, "
                 "os_version, os_name, event_type, event_time, page_url, page_counter, "
                 "element_text, element_tag, element_url, extract_timestamp")
    stream_base = ",".join([
        SRC,
        f"\nsrc1 AS (SELECT * FROM src_h WHERE coalesce(file_ts < {CUT}, FALSE))",
        f"\nsrc2 AS (SELECT * FROM src_h WHERE NOT coalesce(file_ts < {CUT}, FALSE))",
        bronze_ctes("base1", "src1", LOAD_1),
        bronze_ctes("base2", "src2", LOAD_2),
    ])
    q = {
        "raw_load": with_(SRC, raw_proj),
        "stream_ingest": with_(SRC, raw_proj),
        "stream_raw_to_base": with_(stream_base, "SELECT * FROM base1 UNION ALL SELECT * FROM base2"),
        "load_audit": with_(SRC, "SELECT filename, count(*) AS n_rows FROM src GROUP BY filename"),
        "stage_listing": with_(SRC + ",\nsrc_t AS (SELECT *, regexp_extract(filename, "
                               "'\\d{4}-\\d{2}-\\d{2}_\\d{1,2}') AS file_hour FROM src_h)", f"""
            SELECT file_hour, CAST(count(*) FILTER (WHERE coalesce(file_ts < {CUT}, FALSE)) AS BIGINT) AS n_rows,
                   TRUE AS listed
            FROM src_t GROUP BY file_hour"""),
        "bronze_extract": with_(SRC + "," + extract_cte("x", "src_h", LOAD_1), "SELECT * FROM x"),
        "extract_timestamp": with_(SRC, "SELECT event_uuid, filename, file_ts AS extract_timestamp FROM src_h"),
        "event_type_clean": with_(full, "SELECT x.event_uuid, x.event_type AS event_type_raw, b.event_type "
                                        "FROM base_x x JOIN base b ON x.event_uuid = b.event_uuid"),
        "bronze": with_(full, "SELECT * FROM base"),
        "fct": with_(full, "SELECT * FROM fct"),
        "pages": with_(full, "SELECT * FROM pg"),
        "page_titles": with_(full, "SELECT event_uuid, page_url, page_title, parent_page_title FROM pg"),
        "devices": with_(full, "SELECT * FROM dev"),
        "all_events": with_(full, "SELECT * FROM ae"),
        "session_journey": with_(full, "SELECT * FROM sj"),
        "event_duration": with_(full, "SELECT event_uuid, session_id, event_time, next_event_time, "
                                      "CAST(date_diff('second', event_time, next_event_time) AS DECIMAL(21,1)) "
                                      "AS event_duration_s FROM ae_w"),
        "previous_event": with_(full, "SELECT event_uuid, session_id, previous_event_type, previous_page_url "
                                      "FROM ae_w"),
        "event_counter": with_(full, "SELECT event_uuid, session_id, event_counter FROM ae"),
        "repeat_click_flags": with_(full, "SELECT event_uuid, previous_event_repeated, click_error FROM ae"),
        "session_page_path": with_(full, "SELECT * FROM sj_pv"),
        "fct_incr": with_(two, "SELECT * FROM fct_inc"),
        "pages_incr": with_(two, "SELECT * FROM pg_inc"),
        "pages_incr_empty_target": with_(
            two + "," + pages_cte("pg_empty_inc", "base_all", LOAD_2,
                                  "extract_timestamp > (SELECT max(extract_timestamp) FROM pg1 WHERE FALSE)"),
            "SELECT * FROM pg_empty_inc"),
        "devices_merge": with_(two, "SELECT * FROM dev2"),
        "devices_merge_stats": with_(two, """
            SELECT count(*) FILTER (WHERE t.device_id IS NOT NULL AND (
                     t.device_type IS DISTINCT FROM s.device_type OR t.device_family IS DISTINCT FROM s.device_family
                     OR t.platform IS DISTINCT FROM s.platform OR t.os_version IS DISTINCT FROM s.os_version
                     OR t.os_name IS DISTINCT FROM s.os_name)) AS rows_updated,
                   count(*) FILTER (WHERE t.device_id IS NULL) AS rows_inserted
            FROM dev1 t RIGHT JOIN dev_src s ON t.device_id = s.device_id"""),
        "all_events_incr": with_(two, "SELECT * FROM ae_inc"),
        "all_events_incr_unpruned": with_(two, "SELECT * FROM ae_inc"),
        "session_journey_incr": with_(two, "SELECT * FROM sj_inc"),
        "two_batch_silver": with_(two, "SELECT * FROM fct2"),
        "two_batch_pages": with_(two, "SELECT * FROM pg2"),
        "two_batch_gold": with_(two, "SELECT * FROM ae1 UNION ALL SELECT * FROM ae_inc"),
        "two_batch_journey": with_(two, "SELECT * FROM sj1 UNION ALL SELECT * FROM sj_inc"),
        "high_water_marks": with_(two, """
            SELECT 'fct_all_session_events' AS table_name, max(extract_timestamp) AS mark FROM fct1
            UNION ALL SELECT 'dim_event_pages', max(extract_timestamp) FROM pg1
            UNION ALL SELECT 'all_events', max(extract_timestamp) FROM ae1
            UNION ALL SELECT 'session_journey', max(extract_timestamp) FROM sj1"""),
        "late_rows": with_(two_batch_ctes(late=True), """
            SELECT b.event_uuid, b.session_id, b.event_time, b.extract_timestamp
            FROM base_all b WHERE NOT EXISTS (SELECT 1 FROM fct2 f WHERE f.event_uuid = b.event_uuid)"""),
    }
    q |= {"stored_fact": q["two_batch_silver"], "stored_devices": q["devices_merge"], "stored_all_events": q["two_batch_gold"],
          "stored_session_journey": q["two_batch_journey"], "stored_late_rows": q["late_rows"]}
    q["load_stamp"] = "SELECT count(*) AS n_rows, true AS one_stamp, true AS within_the_run FROM events"
    q["stored_order"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, true AS in_order FROM ({q[key]}) AS t_{name}"
        for name, key in (("fct_all_session_events", "two_batch_silver"),
                          ("dim_event_pages", "two_batch_pages"), ("dim_devices", "devices_merge"),
                          ("all_events", "two_batch_gold"), ("session_journey", "two_batch_journey")))
    q["stream_raw_to_base"] = with_(stream_base, f"SELECT {base_cols}, load_timestamp FROM base1 "
                                                 f"UNION ALL SELECT {base_cols}, load_timestamp FROM base2")
    fact_cols = ("event_uuid, session_id, device_id, event_type, event_time, extract_timestamp, "
                 "load_timestamp")
    q["stream_base_to_fact"] = with_(
        stream_base, f"SELECT {fact_cols} FROM base1 UNION ALL SELECT {fact_cols} FROM base2")
    return q


def _norm(v) -> str:
    if v is None:
        return "<null>"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[str, list[str]]:
    """Order-insensitive hash of a result, columns taken in name order."""
    import hashlib

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duckdb_views(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con

"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives the feed from ``events`` and the models with plain window
SQL (QUALIFY-based version starts, JSON path extraction), so it checks the
DataFrame code rather than mirroring it.  Common steps are named CTEs; each
query pulls in only the CTEs it depends on.
"""

from __future__ import annotations

import re

from ..constants import (ACCEPTED_STATUSES, CITY_NAMES, FIXTURE_AS_OF, LOOKAHEAD_DAYS,
                         MAX_PAGES_PER_CITY, PAGE_SIZE, TOP_GENRES_N, UPCOMING_ROWS)

AS_OF = f"DATE '{FIXTURE_AS_OF}'"
SPLIT = "TIMESTAMP '2024-01-20 00:00:00'"


def _list_sql(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _in_sql(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def _sk(*parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + "))"


def _ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%g')"


def _j(path: str) -> str:
    return f"json_extract_string(payload, '$.{path}')"


PAYLOAD_SQL = f"""
'{{"id":"' || event_id || '","name":"Show ' || CAST(u AS VARCHAR) || '","url":"https://t.example/' || event_id
|| '","dates":{{"start":'
|| CASE WHEN u % 17 = 0 THEN '{{"dateTBD":true}}'
        ELSE '{{"localDate":"' || ld || '","localTime":"' || CASE WHEN d > 20 THEN '19:30:00' ELSE '20:00:00' END
             || '","dateTime":"' || ld || 'T01:00:00Z"}}' END
|| ',"status":{{"code":"'
|| CASE WHEN event_type = 'error' AND v >= 100 THEN 'moved' WHEN v >= 150 THEN 'cancelled'
        WHEN v >= 80 THEN 'offsale' ELSE 'onsale' END || '"}}}}'
|| CASE WHEN u % 11 <> 0 THEN ',"classifications":[{{"genre":{{"name":"'
        || ['Rock', 'Country', 'Jazz', 'Alternative', 'Other'][CAST(u % 5 AS INTEGER) + 1]
        || '"}},"subGenre":{{"name":"Sub ' || CAST(u % 3 AS VARCHAR) || '"}}}}]' ELSE '' END
|| CASE WHEN event_type <> 'error' THEN ',"priceRanges":[{{"currency":"USD","min":' || CAST(p AS VARCHAR)
        || ',"max":' || CAST(2 * p AS VARCHAR) || '.5}}]' ELSE '' END
|| ',"_embedded":{{"venues":[{{"id":"V' || CAST(vn AS VARCHAR) || '","name":"Venue ' || CAST(vn AS VARCHAR)
|| CASE WHEN vn % 3 = 0 AND d > 15 THEN ' Hall' ELSE '' END
|| '","city":{{"name":"City ' || CAST(vn % 7 AS VARCHAR) || '"}},"state":{{"stateCode":"S' || CAST(vn % 7 AS VARCHAR)
|| '"}},"country":{{"countryCode":"US"}},"address":{{"line1":"' || CAST(10 * vn AS VARCHAR) || ' Main St"}}'
|| CASE WHEN vn % 7 <> 0 THEN ',"location":{{"latitude":"' || CAST(30 + vn AS VARCHAR) || '.25","longitude":"-'
        || CAST(80 + vn AS VARCHAR) || '.5"}}' ELSE '' END
|| '}}]'
|| CASE WHEN u % 13 <> 0 THEN ',"attractions":[{{"id":"A' || CAST(an AS VARCHAR) || '","name":'
        || CASE WHEN u % 31 = 0 THEN 'null'
                ELSE '"Artist ' || CAST(an AS VARCHAR) || CASE WHEN an % 4 = 0 AND d > 10 THEN ' Band' ELSE '' END || '"' END
        || '}}]' ELSE '' END
|| '}}}}'
"""

TYPED_FIELDS = [
    ("event_name", _j("name")),
    ("event_url", _j("url")),
    ("event_date", f"TRY_CAST({_j('dates.start.localDate')} AS DATE)"),
    ("event_time", _j("dates.start.localTime")),
    ("event_datetime_utc", f"TRY_CAST({_j('dates.start.dateTime')} AS TIMESTAMP)"),
    ("event_status", _j("dates.status.code")),
    ("genre", _j("classifications[0].genre.name")),
    ("sub_genre", _j("classifications[0].subGenre.name")),
    ("venue_id", _j("_embedded.venues[0].id")),
    ("venue_name", _j("_embedded.venues[0].name")),
    ("venue_city", _j("_embedded.venues[0].city.name")),
    ("venue_state_code", _j("_embedded.venues[0].state.stateCode")),
    ("venue_country_code", _j("_embedded.venues[0].country.countryCode")),
    ("venue_address", _j("_embedded.venues[0].address.line1")),
    ("venue_latitude", f"TRY_CAST({_j('_embedded.venues[0].location.latitude')} AS DOUBLE)"),
    ("venue_longitude", f"TRY_CAST({_j('_embedded.venues[0].location.longitude')} AS DOUBLE)"),
    ("artist_id", _j("_embedded.attractions[0].id")),
    ("artist_name", _j("_embedded.attractions[0].name")),
    ("price_min", f"TRY_CAST({_j('priceRanges[0].min')} AS DOUBLE)"),
    ("price_max", f"TRY_CAST({_j('priceRanges[0].max')} AS DOUBLE)"),
    ("price_currency", _j("priceRanges[0].currency")),
]
TYPED_SELECT = ",\n  ".join(f"{expr} AS {name}" for name, expr in TYPED_FIELDS)

EV_W = "PARTITION BY event_id, fetched_city ORDER BY ingested_at"
PLAUSIBLE = (f"(event_date IS NULL OR event_date BETWEEN CAST({AS_OF} - INTERVAL 1 YEAR AS DATE) "
             f"AND CAST({AS_OF} + INTERVAL 5 YEAR AS DATE))")


def _history_sql(src: str, keys: str, tracked: list[str], literal: bool) -> tuple[str, str]:
    """Flag + version CTE bodies for one history."""
    w = f"PARTITION BY {keys} ORDER BY ingested_at"
    diffs = " OR ".join(f"lag({c}) OVER ({w}) IS DISTINCT FROM {c}" for c in tracked)
    first = "" if literal else f"lag(ingested_at) OVER ({w}) IS NULL OR "
    flags = f"SELECT *, CASE WHEN {first}{diffs} THEN 1 ELSE 0 END AS is_new_version FROM {src}"
    ver = (f"SELECT *, CAST(sum(is_new_version) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
           f" AS BIGINT) AS version FROM {{flags}}")
    return flags, ver


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


cte("landed_k", [], f"""
SELECT e.event_id AS seq,
       'E' || lpad(CAST(e.user_id AS VARCHAR), 6, '0') AS event_id,
       {_list_sql(CITY_NAMES)}[CAST((e.user_id + e.event_id % 2) % 7 AS INTEGER) + 1] AS fetched_city,
       CAST(CAST(e.ts AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR AS ingested_at,
       e.user_id AS u, e.value AS v, e.event_type, CAST(day(e.ts) AS BIGINT) AS d,
       e.user_id % 20 AS vn, e.user_id % 40 AS an,
       CAST(CASE WHEN e.user_id % 29 = 0 THEN DATE '2037-01-01'
                 ELSE DATE '2024-02-01' + CAST(e.user_id % 60 + CASE WHEN e.value >= 150 THEN 7 ELSE 0 END AS INTEGER)
            END AS VARCHAR) AS ld,
       20 + 5 * (e.user_id % 8) + CASE WHEN e.value >= 80 THEN 10 ELSE 0 END AS p
FROM events e""")
cte("landed", ["landed_k"], f"SELECT seq, event_id, fetched_city, ingested_at, {PAYLOAD_SQL} AS payload FROM landed_k")
cte("raw_events", ["landed"], """
SELECT event_id, fetched_city, ingested_at, payload FROM landed
QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city, ingested_at ORDER BY seq) = 1""")
cte("typed", ["raw_events"], f"SELECT event_id, fetched_city, ingested_at,\n  {TYPED_SELECT},\n  payload FROM raw_events")
cte("stg_events", ["typed"], f"""
SELECT * FROM (SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city ORDER BY ingested_at DESC) = 1)
WHERE {PLAUSIBLE}""")

_EV_TRACKED = ["event_status", "event_date", "event_time", "price_min", "price_max"]
_SNAP_OUT = "event_status, event_date, event_time, price_min, price_max, price_currency"
_f, _v = _history_sql("typed", "event_id, fetched_city", _EV_TRACKED, literal=False)
cte("snap_flags", ["typed"], _f)
cte("snap_ver", ["snap_flags"], _v.format(flags="snap_flags"))
cte("snap_starts", ["snap_ver"], """
SELECT * FROM snap_ver QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city, version ORDER BY ingested_at) = 1""")
cte("stg_event_snapshots", ["snap_starts"], f"""
SELECT event_id, fetched_city, version, ingested_at AS valid_from,
       lead(ingested_at) OVER ({EV_W}) AS valid_to,
       lead(ingested_at) OVER ({EV_W}) IS NULL AS is_current,
       {_SNAP_OUT}
FROM snap_starts""")
_f, _v = _history_sql("typed", "event_id, fetched_city", _EV_TRACKED, literal=True)
cte("lit_flags", ["typed"], _f)
cte("lit_ver", ["lit_flags"], _v.format(flags="lit_flags"))
cte("stg_event_snapshots_literal", ["lit_ver"], f"""
SELECT event_id, fetched_city, version, ingested_at AS valid_from,
       lead(ingested_at) OVER ({EV_W}) AS valid_to,
       lead(ingested_at) OVER ({EV_W}) IS NULL AS is_current,
       {_SNAP_OUT}
FROM lit_ver
QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city, version ORDER BY ingested_at) = 1""")

cte("art_src", ["typed"], """
SELECT artist_id, artist_name, ingested_at, event_id, fetched_city FROM typed
WHERE artist_id IS NOT NULL AND artist_name IS NOT NULL""")
cte("art_run", ["art_src"], """
SELECT artist_id, ingested_at, event_id, fetched_city, artist_name FROM art_src
QUALIFY row_number() OVER (PARTITION BY artist_id, ingested_at ORDER BY event_id, fetched_city) = 1""")
_f, _v = _history_sql("art_run", "artist_id", ["artist_name"], literal=False)
cte("art_flags", ["art_run"], _f)
cte("art_ver", ["art_flags"], _v.format(flags="art_flags"))
cte("dim_artists", ["art_ver"], f"""
SELECT {_sk('artist_id', _ts('valid_from'))} AS artist_sk, artist_id, artist_name, valid_from,
       lead(valid_from) OVER (PARTITION BY artist_id ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY artist_id ORDER BY valid_from) IS NULL AS is_current
FROM (SELECT artist_id, artist_name, ingested_at AS valid_from FROM art_ver
      QUALIFY row_number() OVER (PARTITION BY artist_id, version ORDER BY ingested_at) = 1)""")

_VEN_TRACKED = ["venue_name", "venue_city", "venue_state_code", "venue_address"]
_VEN_ALL = ("venue_name, venue_city, venue_state_code, venue_country_code, venue_address, "
            "venue_latitude, venue_longitude")
cte("ven_run", ["typed"], f"""
SELECT venue_id, ingested_at, {_VEN_ALL} FROM typed WHERE venue_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY venue_id, ingested_at ORDER BY event_id, fetched_city) = 1""")
_f, _v = _history_sql("ven_run", "venue_id", _VEN_TRACKED, literal=False)
cte("ven_flags", ["ven_run"], _f)
cte("ven_ver", ["ven_flags"], _v.format(flags="ven_flags"))
cte("dim_venues", ["ven_ver"], f"""
SELECT {_sk('venue_id', _ts('valid_from'))} AS venue_sk, venue_id, {_VEN_ALL}, valid_from,
       lead(valid_from) OVER (PARTITION BY venue_id ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY venue_id ORDER BY valid_from) IS NULL AS is_current
FROM (SELECT venue_id, {_VEN_ALL}, ingested_at AS valid_from FROM ven_ver
      QUALIFY row_number() OVER (PARTITION BY venue_id, version ORDER BY ingested_at) = 1)""")

_FCT_SELECT = f"""
SELECT {_sk('e.event_id', 'e.fetched_city', 'e.version')} AS event_sk, a.artist_sk, v.venue_sk,
       e.event_id, s.artist_id, s.venue_id, e.fetched_city, e.version, e.valid_from, e.valid_to, e.is_current,
       e.event_status, e.event_date, e.event_time, e.price_min, e.price_max, e.price_currency,
       s.event_name, s.event_url, s.event_datetime_utc, s.genre, s.sub_genre,
       a.artist_name, v.venue_name, v.venue_city, v.venue_state_code
FROM {{snap}} e
LEFT JOIN stg_events s ON s.event_id = e.event_id AND s.fetched_city = e.fetched_city
LEFT JOIN dim_artists a ON a.artist_id = s.artist_id AND a.valid_from <= e.valid_from
     AND (a.valid_to IS NULL OR e.valid_from < a.valid_to)
LEFT JOIN dim_venues v ON v.venue_id = s.venue_id AND v.valid_from <= e.valid_from
     AND (v.valid_to IS NULL OR e.valid_from < v.valid_to)"""
cte("fct_events", ["stg_event_snapshots", "stg_events", "dim_artists", "dim_venues"],
    _FCT_SELECT.format(snap="stg_event_snapshots"))
cte("fct_events_by_city", ["fct_events"], """
SELECT fetched_city, event_date, genre,
       count(*) AS total_events,
       count(DISTINCT artist_id) AS unique_artists,
       count(DISTINCT venue_id) AS unique_venues,
       min(price_min) AS min_ticket_price,
       max(price_max) AS max_ticket_price,
       avg((price_min + price_max) / 2.0) AS avg_ticket_price
FROM fct_events WHERE event_date IS NOT NULL AND is_current
GROUP BY fetched_city, event_date, genre""")

# dashboard: current facts, default multiselects, full date range
cte("cur", ["fct_events"], "SELECT * FROM fct_events WHERE is_current")
cte("filt", ["cur"], """
SELECT * FROM cur
WHERE fetched_city IN (SELECT fetched_city FROM cur WHERE fetched_city IS NOT NULL)
  AND genre IN (SELECT genre FROM cur WHERE genre IS NOT NULL)
  AND event_date >= (SELECT min(event_date) FROM cur)
  AND event_date <= (SELECT max(event_date) FROM cur)""")
cte("filt_daily", ["cur", "fct_events_by_city"], """
SELECT * FROM fct_events_by_city
WHERE fetched_city IN (SELECT fetched_city FROM cur WHERE fetched_city IS NOT NULL)
  AND genre IN (SELECT genre FROM cur WHERE genre IS NOT NULL)
  AND event_date >= (SELECT min(event_date) FROM cur)
  AND event_date <= (SELECT max(event_date) FROM cur)""")

# landing from page documents
cte("paged", ["landed"], f"""
SELECT fetched_city, ingested_at, (nth - 1) // {PAGE_SIZE} AS page_no, (nth - 1) % {PAGE_SIZE} AS pos, event_id, payload
FROM (SELECT *, row_number() OVER (PARTITION BY fetched_city, ingested_at ORDER BY seq) AS nth FROM landed)""")
cte("capped", ["landed"], f"""
SELECT fetched_city, ingested_at, (nth - 1) // {PAGE_SIZE} AS page_no, (nth - 1) % {PAGE_SIZE} AS pos, event_id, payload
FROM (SELECT *, row_number() OVER (PARTITION BY fetched_city, ingested_at ORDER BY seq) AS nth FROM landed)
WHERE nth <= {MAX_PAGES_PER_CITY * PAGE_SIZE}""")

# incremental: the fact as stored before the split run
cte("raw_before", ["raw_events"], f"SELECT * FROM raw_events WHERE ingested_at < {SPLIT}")

# data checks
_NOT_NULL = [
    ("raw_events", "raw_events", ["event_id", "fetched_city", "ingested_at", "payload"]),
    ("stg_events", "stg_events", ["event_id", "fetched_city", "event_name"]),
    ("stg_event_snapshots", "stg_event_snapshots", ["event_id", "fetched_city", "version", "valid_from", "is_current"]),
    ("dim_artists", "dim_artists", ["artist_sk", "artist_id", "artist_name"]),
    ("dim_venues", "dim_venues", ["venue_sk", "venue_id", "venue_name"]),
    ("fct_events", "fct_events", ["event_sk", "event_id"]),
]
_UNIQUE = [("stg_events", "event_id || '|' || fetched_city"), ("dim_artists", "artist_sk"),
           ("dim_venues", "venue_sk"), ("fct_events", "event_sk")]


def _dq_not_null_sql() -> str:
    parts = []
    for model, table, cols in _NOT_NULL:
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failing_rows FROM {table}")
    return "\nUNION ALL ".join(parts)


def _dq_unique_sql() -> str:
    parts = []
    for model, expr in _UNIQUE:
        parts.append(f"SELECT '{model}' AS model, '{expr.replace(chr(39), chr(39) * 2)}' AS column_name, "
                     f"(SELECT count(*) FROM (SELECT {expr} AS k FROM {model} WHERE {expr} IS NOT NULL "
                     f"GROUP BY k HAVING count(*) > 1)) AS failing_rows")
    return "\nUNION ALL ".join(parts)


_ACCEPTED = f"""
SELECT 'fct_events' AS model, 'event_status' AS column_name, event_status AS value, count(*) AS n_rows
FROM fct_events WHERE event_status IS NOT NULL AND event_status NOT IN {_in_sql(ACCEPTED_STATUSES)}
GROUP BY event_status"""

cte("dq_not_null", [t for _, t, _ in _NOT_NULL], _dq_not_null_sql())
cte("dq_unique", [m for m, _ in _UNIQUE], _dq_unique_sql())
cte("dq_accepted", ["fct_events"], _ACCEPTED)


def _closure(name: str, acc: list[str]) -> list[str]:
    if name not in acc:
        for d in CTES[name][0]:
            _closure(d, acc)
        acc.append(name)
    return acc


def suffixed_chain(top: str, base: str, replacement: str, suffix: str) -> None:
    """Copy the CTEs between ``base`` and ``top`` with ``suffix``, reading ``replacement``."""
    chain = [n for n in _closure(top, []) if base in _closure(n, []) and n != base]
    rename = {n: n + suffix for n in chain}
    rename[base] = replacement
    for n in chain:
        deps, body = CTES[n]
        for old, new in sorted(rename.items(), key=lambda kv: -len(kv[0])):
            body = re.sub(rf"\b{old}\b", new, body)
        cte(n + suffix, [rename.get(d, d) for d in deps], body)


def with_ctes(sql: str, needed: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    tail = sql.strip()
    if tail[:4].upper() == "WITH":  # fold the query's own CTEs into the list
        return f"WITH {body},\n{tail[4:].lstrip()}"
    return f"WITH {body}\n{tail}"


suffixed_chain("fct_events", "raw_events", "raw_before", "_b")

_STG_COLS = "event_id, fetched_city, ingested_at, " + ", ".join(n for n, _ in TYPED_FIELDS) + ", payload"
_FCT_COLS = ("event_sk, artist_sk, venue_sk, event_id, artist_id, venue_id, fetched_city, version, valid_from, "
             "valid_to, is_current, event_status, event_date, event_time, price_min, price_max, price_currency, "
             "event_name, event_url, event_datetime_utc, genre, sub_genre, artist_name, venue_name, venue_city, "
             "venue_state_code")


def _q(sql: str, *needed: str) -> str:
    return with_ctes(sql, list(needed))


def oracle_sql() -> dict[str, str]:
    typed_cols = "event_id, fetched_city, ingested_at, " + ", ".join(n for n, _ in TYPED_FIELDS)
    q: dict[str, str] = {}
    # sources
    q["raw_events"] = _q("SELECT * FROM raw_events", "raw_events")
    q["land_pages"] = _q("SELECT fetched_city, ingested_at, page_no, pos, event_id, payload FROM paged", "paged")
    q["cap_per_city"] = _q("SELECT fetched_city, ingested_at, page_no, pos, event_id, payload FROM capped", "capped")
    q["run_dedup"] = _q("""SELECT event_id, fetched_city, ingested_at, payload FROM paged
        WHERE event_id <> ''
        QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city, ingested_at ORDER BY page_no, pos) = 1""",
                        "paged")
    q["raw_documents"] = _q("""SELECT event_id, fetched_city, ingested_at,
        CAST(json_object('event_name', event_name, 'event_status', event_status, 'price_min', price_min, 'genre', genre)
             AS VARCHAR) AS document FROM typed""", "typed")
    # projections
    q["flatten_payload"] = _q(f"SELECT {typed_cols} FROM typed", "typed")
    q["flatten_variant"] = q["flatten_payload"]
    q["parse_json_strict"] = _q("SELECT event_id, fetched_city, ingested_at, event_name, event_status, price_min FROM typed",
                                "typed")
    q["json_valid"] = _q("SELECT event_id, fetched_city, ingested_at, json_valid(payload) AS is_valid_json "
                         "FROM raw_events", "raw_events")
    q["surrogate_key"] = _q(f"SELECT event_id, fetched_city, ingested_at, "
                            f"{_sk('event_id', 'fetched_city', _ts('ingested_at'))} AS observation_sk "
                            f"FROM raw_events", "raw_events")
    # filters
    q["plausible_dates"] = _q(f"SELECT event_id, fetched_city, ingested_at, event_date FROM typed WHERE {PLAUSIBLE}",
                              "typed")
    q["current_events"] = _q("SELECT * FROM cur", "cur")
    q["mappable_venues"] = _q("SELECT * FROM dim_venues WHERE venue_latitude IS NOT NULL "
                              "AND venue_longitude IS NOT NULL AND is_current", "dim_venues")
    q["dashboard_filter"] = _q("SELECT * FROM filt", "filt")
    q["dashboard_filter_daily"] = _q("SELECT * FROM filt_daily", "filt_daily")
    # joins
    q["events_with_attrs"] = _q("""
        SELECT e.*, s.event_name, s.event_url, s.event_datetime_utc, s.genre, s.sub_genre, s.venue_id, s.artist_id
        FROM stg_event_snapshots e LEFT JOIN stg_events s
          ON s.event_id = e.event_id AND s.fetched_city = e.fetched_city""", "stg_event_snapshots", "stg_events")
    q["pit_join_artists"] = _q("""
        SELECT e.event_id, e.fetched_city, e.version, e.valid_from, s.artist_id, a.artist_sk, a.artist_name
        FROM stg_event_snapshots e
        LEFT JOIN stg_events s ON s.event_id = e.event_id AND s.fetched_city = e.fetched_city
        LEFT JOIN dim_artists a ON a.artist_id = s.artist_id AND a.valid_from <= e.valid_from
             AND (a.valid_to IS NULL OR e.valid_from < a.valid_to)""",
                               "stg_event_snapshots", "stg_events", "dim_artists")
    q["pit_join_venues"] = _q("""
        SELECT e.event_id, e.fetched_city, e.version, e.valid_from, s.venue_id, v.venue_sk, v.venue_name,
               v.venue_city, v.venue_state_code
        FROM stg_event_snapshots e
        LEFT JOIN stg_events s ON s.event_id = e.event_id AND s.fetched_city = e.fetched_city
        LEFT JOIN dim_venues v ON v.venue_id = s.venue_id AND v.valid_from <= e.valid_from
             AND (v.valid_to IS NULL OR e.valid_from < v.valid_to)""",
                              "stg_event_snapshots", "stg_events", "dim_venues")
    q["venue_map"] = _q("""
        SELECT v.*, c.event_count
        FROM dim_venues v
        JOIN (SELECT venue_id, count(*) AS event_count FROM filt GROUP BY venue_id) c ON c.venue_id = v.venue_id
        WHERE v.venue_latitude IS NOT NULL AND v.venue_longitude IS NOT NULL AND v.is_current""",
                        "dim_venues", "filt")
    q["merge_upsert"] = _q(f"""
        WITH tgt AS (SELECT {_FCT_COLS} FROM fct_events_b),
        src AS (SELECT {_FCT_COLS} FROM fct_events
                WHERE valid_from > (SELECT coalesce(max(valid_from), TIMESTAMP '1900-01-01 00:00:00') FROM tgt))
        SELECT * FROM tgt WHERE event_sk NOT IN (SELECT event_sk FROM src)
        UNION ALL SELECT * FROM src""", "fct_events_b", "fct_events")
    q["fct_incremental"] = _q(f"SELECT {_FCT_COLS} FROM fct_events", "fct_events")
    q["fct_extend"] = _q(f"SELECT {_FCT_COLS} FROM fct_events", "fct_events")
    q["fct_late_day"] = q["fct_incremental"]
    q["pit_merge_artists"], q["pit_merge_venues"] = q["pit_join_artists"], q["pit_join_venues"]
    # aggregations
    q["uniques_by_city"] = _q("""SELECT fetched_city, count(DISTINCT artist_id) AS unique_artists,
        count(DISTINCT venue_id) AS unique_venues
        FROM fct_events WHERE event_date IS NOT NULL AND is_current GROUP BY fetched_city""", "fct_events")
    q["fct_events_by_city"] = _q("SELECT * FROM fct_events_by_city", "fct_events_by_city")
    q["events_by_city"] = _q("SELECT fetched_city, count(*) AS total_events FROM filt GROUP BY fetched_city",
                             "filt")
    q["top_genres"] = _q(f"""SELECT genre, count(*) AS event_count FROM filt GROUP BY genre
        ORDER BY event_count DESC, genre LIMIT {TOP_GENRES_N}""", "filt")
    q["events_over_time"] = _q(f"""
        SELECT event_date, fetched_city, CAST(sum(total_events) AS BIGINT) AS total_events FROM filt_daily
        WHERE event_date <= CAST({AS_OF} + INTERVAL {LOOKAHEAD_DAYS} DAY AS DATE)
        GROUP BY event_date, fetched_city""", "filt_daily")
    q["kpi_display"] = _q("""SELECT count(*) AS total_events, count(DISTINCT artist_name) AS unique_artists,
        count(DISTINCT venue_id) AS unique_venues,
        coalesce(printf('$%.2f', avg(price_min)), 'N/A') AS avg_min_price FROM filt""", "filt")
    q["kpis"] = _q("""SELECT count(*) AS total_events, count(DISTINCT artist_name) AS unique_artists,
        count(DISTINCT venue_id) AS unique_venues, avg(price_min) AS avg_min_price FROM filt""", "filt")
    q["price_distribution"] = _q("""
        WITH s AS (
          SELECT fetched_city, count(*) AS n, min(price_min) AS min_price,
                 quantile_cont(price_min, 0.25) AS q1, quantile_cont(price_min, 0.5) AS median,
                 quantile_cont(price_min, 0.75) AS q3, max(price_min) AS max_price
          FROM filt WHERE price_min IS NOT NULL GROUP BY fetched_city),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM s)
        SELECT f.*,
               (SELECT min(price_min) FROM filt x WHERE x.fetched_city = f.fetched_city
                  AND x.price_min BETWEEN f.lower_fence AND f.upper_fence) AS lower_whisker,
               (SELECT max(price_min) FROM filt x WHERE x.fetched_city = f.fetched_city
                  AND x.price_min BETWEEN f.lower_fence AND f.upper_fence) AS upper_whisker,
               (SELECT count(*) FROM filt x WHERE x.fetched_city = f.fetched_city AND x.price_min IS NOT NULL
                  AND NOT (x.price_min BETWEEN f.lower_fence AND f.upper_fence)) AS n_outliers
        FROM f""", "filt")
    q["high_water_mark"] = _q("""SELECT coalesce(max(valid_from), TIMESTAMP '1900-01-01 00:00:00')
        AS high_water_mark FROM fct_events""", "fct_events")
    q["filter_values"] = _q("""
        SELECT DISTINCT 'city' AS kind, fetched_city AS value FROM cur WHERE fetched_city IS NOT NULL
        UNION SELECT DISTINCT 'genre' AS kind, genre AS value FROM cur WHERE genre IS NOT NULL""", "cur")
    q["date_bounds"] = _q("SELECT min(event_date) AS min_date, max(event_date) AS max_date FROM cur", "cur")
    # windows
    q["latest_per_key"] = _q("""SELECT * FROM raw_events
        QUALIFY row_number() OVER (PARTITION BY event_id, fetched_city ORDER BY ingested_at DESC) = 1""",
                             "raw_events")
    q["dedup_per_run"] = _q("SELECT * FROM art_run", "art_run")
    q["change_flags"] = _q("SELECT event_id, fetched_city, ingested_at, is_new_version FROM snap_flags",
                           "snap_flags")
    q["version_numbers"] = _q("SELECT event_id, fetched_city, ingested_at, is_new_version, version FROM snap_ver",
                              "snap_ver")
    # sort / limit
    q["upcoming_events"] = _q(f"""
        SELECT event_name AS "Event", fetched_city AS "City", event_date AS "Date", artist_name AS "Artist",
               venue_name AS "Venue", genre AS "Genre", price_min AS "Min Price", price_max AS "Max Price",
               event_url AS "Ticket Link"
        FROM filt ORDER BY event_date NULLS LAST, event_sk LIMIT {UPCOMING_ROWS}""", "filt")
    q["upcoming_counts"] = _q(f"SELECT least(count(*), {UPCOMING_ROWS}) AS shown, count(*) AS total FROM filt",
                              "filt")
    # models
    q["stg_events"] = _q(f"SELECT {_STG_COLS} FROM stg_events", "stg_events")
    q["stg_event_snapshots"] = _q("SELECT * FROM stg_event_snapshots", "stg_event_snapshots")
    q["stg_event_snapshots_literal"] = _q("SELECT * FROM stg_event_snapshots_literal",
                                          "stg_event_snapshots_literal")
    q["dim_artists"] = _q("SELECT * FROM dim_artists", "dim_artists")
    q["dim_venues"] = _q("SELECT * FROM dim_venues", "dim_venues")
    q["fct_events"] = _q(f"SELECT {_FCT_COLS} FROM fct_events", "fct_events")
    # findings
    q["city_share"] = _q("""SELECT fetched_city, count(*) AS total_events,
        count(*) / sum(count(*)) OVER () AS share FROM filt GROUP BY fetched_city""", "filt")
    q["top_genre_per_city"] = _q("""SELECT fetched_city, genre, count(*) AS event_count FROM filt
        GROUP BY fetched_city, genre
        QUALIFY row_number() OVER (PARTITION BY fetched_city ORDER BY count(*) DESC, genre) = 1""", "filt")
    q["city_price_rank"] = _q("""SELECT fetched_city, avg(price_min) AS avg_min_price,
        avg(price_max) AS avg_max_price, count(price_min) AS priced_events,
        rank() OVER (ORDER BY avg(price_min) DESC NULLS LAST) AS price_rank
        FROM filt GROUP BY fetched_city""", "filt")
    q["price_changes"] = _q("""
        SELECT event_id, fetched_city, version, valid_from, prev_status, event_status,
               prev_price_min, price_min, prev_price_max, price_max,
               prev_status IS DISTINCT FROM event_status AS status_changed,
               (prev_price_min IS DISTINCT FROM price_min OR prev_price_max IS DISTINCT FROM price_max) AS price_changed
        FROM (SELECT *, lag(event_status) OVER w AS prev_status, lag(price_min) OVER w AS prev_price_min,
                     lag(price_max) OVER w AS prev_price_max, lag(version) OVER w AS prev_version
              FROM stg_event_snapshots
              WINDOW w AS (PARTITION BY event_id, fetched_city ORDER BY valid_from))
        WHERE prev_version IS NOT NULL
          AND (prev_status IS DISTINCT FROM event_status OR prev_price_min IS DISTINCT FROM price_min
               OR prev_price_max IS DISTINCT FROM price_max)""", "stg_event_snapshots")
    # data checks
    q["dq_not_null"] = _q("SELECT * FROM dq_not_null", "dq_not_null")
    q["dq_unique"] = _q("SELECT * FROM dq_unique", "dq_unique")
    q["dq_accepted_values"] = _q("SELECT * FROM dq_accepted", "dq_accepted")
    q["dq_report"] = _q("""
        WITH r AS (
          SELECT model, 'not_null' AS test, column_name, 'error' AS severity, failing_rows FROM dq_not_null
          UNION ALL SELECT model, 'unique', column_name, 'error', failing_rows FROM dq_unique
          UNION ALL SELECT 'fct_events', 'accepted_values', 'event_status', 'warn',
                           (SELECT count(*) FROM dq_accepted))
        SELECT model, test, column_name, severity,
               CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status,
               CAST(failing_rows AS BIGINT) AS failing_rows
        FROM r""", "dq_not_null", "dq_unique", "dq_accepted")
    return q

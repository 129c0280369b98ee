"""DuckDB SQL that must return the same rows as each registered query.

The driver registers only the raw test tables, so the domain views of
``riverflow.fixtures`` are inlined as CTEs.  Column names and types are
aligned with the Spark side (BIGINT counts and months, TIMESTAMP for the
``timestamp_ntz`` test columns, typed NULLs for columns the mapping leaves
empty).  Every ORDER BY states its NULL placement explicitly.
"""

from __future__ import annotations

from riverflow import schemas
from riverflow.plans import catalog as C

_SQL_TYPE = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
             "BooleanType()": "BOOLEAN", "TimestampType()": "TIMESTAMP", "DateType()": "DATE"}


def _null(name: str, fields) -> str:
    t = dict(fields)[name]
    return f"CAST(NULL AS {_SQL_TYPE[repr(t)]}) AS {name}"


def _select_full(fields, given: dict[str, str]) -> str:
    return ",\n  ".join(f"{given[n]} AS {n}" if n in given else _null(n, fields) for n, _ in fields)


_LIVE_BASE_GIVEN = {
    "code_site": "'T' || CAST(user_id % 20 AS VARCHAR)",
    "code_station": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'S' || CAST(user_id AS VARCHAR) END",
    "grandeur_hydro": "CASE WHEN event_type IN ('click', 'view') THEN 'Q' "
                      "WHEN event_type IN ('error', 'signup') THEN 'H' END",
    "statut_serie": "CAST(event_id % 3 AS BIGINT)",
    "date_obs": "ts",
    "resultat_obs": "value * 400",
    "longitude": "CAST(-6 + user_id % 17 AS DOUBLE)",
    "latitude": "CAST(40 + user_id % 14 AS DOUBLE)",
}

_OBS_GIVEN = {
    "code_site": "'T' || CAST(l_suppkey % 20 AS VARCHAR)",
    "code_station": "'S' || CAST(l_suppkey AS VARCHAR)",
    "grandeur_hydro": "CASE WHEN l_linestatus = 'F' THEN 'Q' ELSE 'H' END",
    "date_obs": "l_shipdate",
    "resultat_obs": "l_extendedprice",
    "longitude": "CAST(-6 + l_suppkey % 17 AS DOUBLE)",
    "latitude": "CAST(40 + l_suppkey % 14 AS DOUBLE)",
}

_HIST_FLAT_FIELDS = [(n, t) for n, t in schemas.HIST_RECORD_FIELDS if n != "date_prod"] + [
    ("prev", schemas.S), ("json_file", schemas.S)]
_HIST_GIVEN = {
    "code_station": "'S' || CAST(l_suppkey AS VARCHAR)",
    "code_site": "'T' || CAST(l_suppkey % 20 AS VARCHAR)",
    "grandeur_hydro_elab": "CASE WHEN l_linestatus = 'F' THEN 'QmJ' ELSE 'other' END",
    "resultat_obs_elab": "CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END",
    "date_obs_elab": "CAST(l_shipdate AS DATE)",
    "longitude": "CAST(-6 + l_suppkey % 17 AS DOUBLE)",
    "latitude": "CAST(40 + l_suppkey % 14 AS DOUBLE)",
    "json_file": "'obs_elab_QmJ_' || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') || '.json'",
}

FX_LIVE_BASE = ("fx_live_base AS (SELECT\n  " + _select_full(schemas.LIVE_FIELDS, _LIVE_BASE_GIVEN)
                + "\nFROM events)")
FX_LIVE_RAW = ("fx_live_raw AS (\n"
               "  SELECT *, date_obs + INTERVAL 5 MINUTE AS ingestion_timestamp FROM fx_live_base\n"
               "  UNION ALL\n"
               "  SELECT *, date_obs + INTERVAL 10 MINUTE AS ingestion_timestamp FROM fx_live_base)")
FX_OBS = ("fx_obs AS (SELECT\n  " + _select_full(schemas.LIVE_FIELDS, _OBS_GIVEN)
          + "\nFROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01 00:00:00')")
FX_HIST_FLAT = ("fx_hist_flat AS (SELECT\n  " + _select_full(_HIST_FLAT_FIELDS, _HIST_GIVEN)
                + "\nFROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01 00:00:00')")
FX_STATIONS = ("fx_stations AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code_station, "
               "s_name AS libelle_station, n_name AS libelle_commune, "
               "CAST(n_nationkey AS VARCHAR) AS code_departement, r_name AS libelle_region\n"
               "FROM supplier JOIN nation ON s_nationkey = n_nationkey "
               "JOIN region ON n_regionkey = r_regionkey)")

_DEDUP_COLS = ", ".join(schemas.LIVE_DEDUP_COLUMNS)
_Q = schemas.QUANTILE_COLUMNS

HIST_AGG = ("hist_agg AS (SELECT code_station, latitude, longitude, grandeur_hydro_elab,\n  "
            + ",\n  ".join(f"quantile_disc(resultat_obs_elab, {f}) AS {c}"
                           for f, c in zip(schemas.QUANTILE_FRACTIONS, _Q))
            + ",\n  min(date_obs_elab) AS minimum_date_window, max(date_obs_elab) AS maximum_date_window\n"
            "FROM fx_hist_flat WHERE grandeur_hydro_elab = 'QmJ' AND resultat_obs_elab > 0\n"
            "GROUP BY code_station, latitude, longitude, grandeur_hydro_elab)")

_LATEST_ORDER = ", ".join(
    f"{c} DESC NULLS LAST" for c in
    ["date_obs", "resultat_obs"] + [c for c in schemas.LIVE_DEDUP_COLUMNS
                                    if c not in ("date_obs", "resultat_obs", "code_station",
                                                 "grandeur_hydro")])


def _dedup(name: str, src: str) -> str:
    return f"{name} AS (SELECT DISTINCT {_DEDUP_COLS} FROM {src})"


def _latest(name: str, src: str) -> str:
    return (f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code_station, "
            f"grandeur_hydro ORDER BY {_LATEST_ORDER}) AS row_num FROM {src}) WHERE row_num = 1)")


def _recent(name: str, src: str) -> str:
    return (f"{name} AS (SELECT code_station, grandeur_hydro, date_obs, resultat_obs FROM {src} "
            f"WHERE date_obs >= (SELECT max(date_obs) FROM {src}) - INTERVAL 24 HOUR "
            "AND code_station IS NOT NULL)")


def _indicator(live: str, coords: str = "l") -> str:
    q = ", ".join(f"h.{c}" for c in _Q)
    return (
        "SELECT CASE WHEN l.resultat_obs > h.quantile_990 THEN 1.0 "
        "WHEN l.resultat_obs < h.quantile_010 THEN 0.0 "
        "ELSE (l.resultat_obs - h.quantile_010) / nullif(h.quantile_990 - h.quantile_010, 0) "
        "END AS flood_indicateur,\n"
        f"  {coords}.longitude AS longitude, {coords}.latitude AS latitude, l.date_obs, "
        f"l.resultat_obs, l.code_station, {q}\n"
        f"FROM {live} l JOIN hist_agg h ON l.code_station = h.code_station\n"
        f"WHERE l.grandeur_hydro = 'Q' AND {coords}.latitude BETWEEN 41 AND 52 "
        f"AND {coords}.longitude BETWEEN -5 AND 9")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _ind_latest_cte(name: str, live: str) -> str:
    return f"{name} AS ({_indicator(live)})"


ISO = "'%Y-%m-%dT%H:%M:%SZ'"
S = C.STATION


def _file_before(day: str) -> str:
    return f"json_file < 'obs_elab_QmJ_{day}.json'"


_IND_RECENT_EVENTS = _with(FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"),
                           _recent("recent", "dedup"))
_EVENTS_LATEST_IND = _with(FX_LIVE_BASE, FX_LIVE_RAW, FX_HIST_FLAT, HIST_AGG,
                           _dedup("dedup", "fx_live_raw"), _latest("latest", "dedup"),
                           _ind_latest_cte("ind", "latest"))
_OBS_LATEST_IND = _with(FX_OBS, FX_HIST_FLAT, HIST_AGG, _dedup("dedup", "fx_obs"),
                        _latest("latest", "dedup"), _ind_latest_cte("ind", "latest"))

ORACLE: dict[str, str] = {
    "indicator": _with(FX_OBS, FX_HIST_FLAT, HIST_AGG, _dedup("dedup", "fx_obs"))
    + _indicator("dedup"),
    "indicator_latest": _OBS_LATEST_IND + "SELECT * FROM ind",
    "indicator_recent": _with(FX_LIVE_BASE, FX_LIVE_RAW, FX_HIST_FLAT, HIST_AGG,
                              _dedup("dedup", "fx_live_raw"), _recent("recent", "dedup"))
    + _indicator("recent", coords="h"),
    "hist_agg": _with(FX_HIST_FLAT, HIST_AGG) + "SELECT * FROM hist_agg",
    "hist_agg_exact": _with(FX_HIST_FLAT, HIST_AGG) + "SELECT * FROM hist_agg",
    "live_dedup": _with(FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"))
    + "SELECT * FROM dedup",
    "live_latest": _with(FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"),
                         _latest("latest", "dedup")) + "SELECT * FROM latest",
    "live_recent": _IND_RECENT_EVENTS
    + "SELECT * FROM recent ORDER BY code_station NULLS FIRST, date_obs NULLS FIRST",
    "live_avg": _with(FX_OBS, _dedup("dedup", "fx_obs"))
    + f"SELECT code_station, CAST(month(date_obs) AS BIGINT) AS month, "
      f"round(avg(resultat_obs), {C.AVG_DIGITS}) AS avg_resultat_obs\n"
      "FROM dedup WHERE grandeur_hydro = 'H' GROUP BY code_station, month(date_obs)\n"
      "ORDER BY code_station NULLS FIRST, month NULLS FIRST",
    "not_in_files": _with(FX_HIST_FLAT)
    + "SELECT * FROM fx_hist_flat WHERE json_file NOT IN (SELECT json_file FROM fx_hist_flat "
      f"WHERE {_file_before(C.NOT_IN_TARGET_BEFORE)})",
    "load_new_files": _with(FX_HIST_FLAT)
    + "SELECT * FROM fx_hist_flat s WHERE NOT EXISTS (SELECT 1 FROM fx_hist_flat t "
      f"WHERE t.{_file_before(C.NOT_IN_TARGET_BEFORE)} AND t.json_file = s.json_file)",
    "loaded_files": _with(FX_HIST_FLAT) + "SELECT DISTINCT json_file FROM fx_hist_flat",
    "file_row_counts": _with(FX_HIST_FLAT)
    + "SELECT json_file, count(*) AS n_rows FROM fx_hist_flat GROUP BY json_file",
    "hist_flatten": _with(FX_HIST_FLAT) + "SELECT * FROM fx_hist_flat",
    "flatten_incremental": _with(FX_HIST_FLAT) + "SELECT * FROM fx_hist_flat",
    "backfill_days": _with(FX_HIST_FLAT)
    + "SELECT CAST(d AS DATE) AS day, 'obs_elab_QmJ_' || strftime(d, '%Y-%m-%d') || '.json' "
      "AS json_file\n"
      f"FROM generate_series((SELECT min(date_obs_elab) FROM fx_hist_flat) - "
      f"INTERVAL {C.BACKFILL_MARGIN_DAYS} DAY, (SELECT max(date_obs_elab) FROM fx_hist_flat) + "
      f"INTERVAL {C.BACKFILL_MARGIN_DAYS} DAY, INTERVAL 1 DAY) g(d)\n"
      "WHERE 'obs_elab_QmJ_' || strftime(d, '%Y-%m-%d') || '.json' NOT IN "
      "(SELECT json_file FROM fx_hist_flat)",
    "file_tag": _with(FX_HIST_FLAT)
    + "SELECT day, json_file, landing_path, string_split(landing_path, '/')[-1] AS basename, "
      "year FROM (\n"
      "  SELECT day, 'obs_elab_QmJ_' || strftime(day, '%Y-%m-%d') || '.json' AS json_file,\n"
      "    'historical/' || CAST(year(day) AS VARCHAR) || '/obs_elab_QmJ_' || "
      "strftime(day, '%Y-%m-%d') || '.json' AS landing_path,\n"
      "    CAST(year(day) AS BIGINT) AS year\n"
      "  FROM (SELECT DISTINCT date_obs_elab AS day FROM fx_hist_flat))",
    "stamp_ingestion": _with(FX_LIVE_BASE)
    + f"SELECT *, TIMESTAMP '{C.FIXED_CLOCK.replace(microsecond=0)}' AS ingestion_timestamp "
      "FROM fx_live_base",
    "pull_windows": "WITH b AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s FROM events),\n"
    "w AS (SELECT s AS window_start FROM b UNION ALL "
    "SELECT s - INTERVAL 5 MINUTE AS window_start FROM b)\n"
    "SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end,\n"
    f"  strftime(window_start, {ISO}) AS date_debut_obs,\n"
    f"  strftime(window_start + INTERVAL 10 MINUTE, {ISO}) AS date_fin_obs,\n"
    "  count(*) AS n_obs\nFROM w GROUP BY window_start",
    "merge_pages": _with(FX_LIVE_BASE) + "SELECT * FROM fx_live_base",
    "json_roundtrip": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k "
                      "FROM events",
    "bbox_filter": _with(FX_OBS)
    + "SELECT * FROM fx_obs WHERE latitude BETWEEN 41 AND 52 AND longitude BETWEEN -5 AND 9",
    "station_history": _with(FX_HIST_FLAT, FX_STATIONS)
    + "SELECT hf.resultat_obs_elab, hf.date_obs_elab, st.libelle_commune, st.code_departement\n"
      "FROM fx_hist_flat hf JOIN fx_stations st ON hf.code_station = st.code_station\n"
      f"WHERE hf.code_station = '{S}'",
    "station_live": _IND_RECENT_EVENTS
    + f"SELECT resultat_obs, date_obs FROM recent WHERE code_station = '{S}' "
      "AND grandeur_hydro = 'Q'",
    "station_ymax": _with(FX_HIST_FLAT, FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"),
                          _recent("recent", "dedup"))
    + f"SELECT max(v) AS max_y FROM (SELECT resultat_obs_elab AS v FROM fx_hist_flat "
      f"WHERE code_station = '{S}'\n"
      f"  UNION ALL SELECT resultat_obs AS v FROM recent WHERE code_station = '{S}' "
      "AND grandeur_hydro = 'Q')",
    "station_thresholds": _OBS_LATEST_IND
    + "SELECT resultat_obs, quantile_999, quantile_990, quantile_900 FROM ind "
      f"WHERE code_station = '{S}'",
    "map_stations": _EVENTS_LATEST_IND
    + ", cur AS (SELECT *, CASE WHEN resultat_obs IS NULL THEN NULL ELSE "
      "least(greatest(resultat_obs / nullif(quantile_990, 0), 0.0), 5.0) END AS map_ratio\n"
      "  FROM ind WHERE date_obs >= (SELECT max(date_obs) FROM ind) - INTERVAL 24 HOUR "
      "AND code_station IS NOT NULL)\n"
      "SELECT code_station, date_obs, flood_indicateur, resultat_obs, latitude, longitude,\n"
      "  quantile_999, quantile_990, quantile_900, quantile_001, map_ratio,\n"
      "  least(50.0, 2 + 15 * map_ratio) AS radius, least(map_ratio, 1.0) AS severity\n"
      "FROM cur WHERE map_ratio > 0 ORDER BY date_obs DESC NULLS LAST, code_station NULLS FIRST",
    "live_top20": _with(FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"),
                        _latest("latest", "dedup"))
    + "SELECT code_station, code_site, date_obs, resultat_obs, grandeur_hydro FROM latest\n"
      "ORDER BY date_obs DESC NULLS LAST, code_station ASC NULLS LAST, "
      "grandeur_hydro ASC NULLS LAST, resultat_obs DESC NULLS LAST, code_site ASC NULLS LAST "
      "LIMIT 20",
}

ORACLE["live_top20_since"] = ORACLE["live_top20"].replace(
    "FROM latest\nORDER BY", "FROM latest\n"
    "WHERE date_obs > (SELECT max(date_obs) - INTERVAL 1 DAY FROM latest)\nORDER BY")
ORACLE["daily_runs"] = (
    _with(FX_HIST_FLAT)
    + "SELECT DISTINCT CAST(date_obs_elab AS DATE) AS run_day,\n"
      "  CAST(date_obs_elab - INTERVAL 1 DAY AS DATE) AS fetched_day,\n"
      "  strftime(date_obs_elab - INTERVAL 1 DAY, 'historical/%Y/obs_elab_QmJ_%Y-%m-%d.json') AS landing_path\n"
      "FROM fx_hist_flat WHERE date_obs_elab IS NOT NULL")

# Streaming and incremental forms: the same rows as their batch models.
ORACLE["live_dedup_incremental"] = ORACLE["live_dedup"]
ORACLE["live_latest_incremental"] = ORACLE["live_latest"]
ORACLE["live_avg_incremental"] = (
    _with(FX_LIVE_BASE, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw"))
    + f"SELECT code_station, CAST(month(date_obs) AS BIGINT) AS month, "
      f"round(avg(resultat_obs), {C.AVG_DIGITS}) AS avg_resultat_obs\n"
      "FROM dedup WHERE grandeur_hydro = 'H' GROUP BY code_station, month(date_obs)")
ORACLE["live_shared_load"] = ORACLE["live_dedup"]
ORACLE["stream_dedup"] = ORACLE["live_dedup"]
ORACLE["stream_dedup_exact"] = ORACLE["live_dedup"]
ORACLE["stream_latest"] = ORACLE["live_latest"]
ORACLE["stream_indicator"] = (_with(FX_LIVE_BASE, FX_LIVE_RAW, FX_HIST_FLAT, HIST_AGG,
                                    _dedup("dedup", "fx_live_raw")) + _indicator("dedup"))
ORACLE["stream_pull_windows"] = ORACLE["pull_windows"]
_ON_TIME = (FX_LIVE_BASE.removesuffix(")")
            + f" WHERE NOT (ts < TIMESTAMP '{C.LATE_BEFORE}' AND event_id % {C.LATE_EVERY} = 0))")
ORACLE["stream_dedup_watermark"] = (_with(_ON_TIME, FX_LIVE_RAW, _dedup("dedup", "fx_live_raw")) + "SELECT * FROM dedup")
ORACLE["stream_indicator_watermark"] = (_with(_ON_TIME, FX_LIVE_RAW, FX_HIST_FLAT, HIST_AGG,
                                              _dedup("dedup", "fx_live_raw")) + _indicator("dedup"))
ORACLE["land_load_hist"] = ORACLE["hist_flatten"]
ORACLE["hist_refresh"] = ORACLE["hist_agg_exact"]
ORACLE["stations_refresh"] = (_with(FX_STATIONS)
                              + f"SELECT {', '.join(C.STATION_COLUMNS)} FROM fx_stations")
ORACLE["json_encode"] = "SELECT event_id, user_id, event_type FROM events"
ORACLE["stations_versions"] = ORACLE["stations_refresh"]
ORACLE["station_history_lookup"] = ORACLE["station_history"]

_PAGE_NO = f"event_id // {C.PAGE_SIZE}"
_LIVE_COLUMNS = _select_full(schemas.LIVE_FIELDS, _LIVE_BASE_GIVEN)


def _chain(links: str) -> str:
    """Pages reached from p0, with their positions."""
    return (f"WITH RECURSIVE ids AS (SELECT DISTINCT {_PAGE_NO} AS no FROM events),\n"
            f"links AS ({links}),\n"
            "chain AS (SELECT page, next, CAST(0 AS BIGINT) AS position FROM links WHERE page = 'p0'\n"
            "  UNION ALL SELECT l.page, l.next, c.position + 1 FROM chain c JOIN links l ON l.page = c.next)\n")


_NEXT = "CASE WHEN no < (SELECT max(no) FROM ids) THEN 'p' || (no + 1) END"
ORACLE["merge_pages_chain"] = (
    _chain(f"SELECT 'p' || no AS page, {_NEXT} AS next FROM ids "
           f"UNION ALL SELECT 'old' || no, {_NEXT} FROM ids WHERE no % 3 = 0")
    + f"SELECT {_LIVE_COLUMNS} FROM events WHERE 'p' || ({_PAGE_NO}) IN (SELECT page FROM chain)")
_LOST = f"no % {C.LOST_PAGE_EVERY} = {C.LOST_PAGE_EVERY - 1}"
ORACLE["page_chain_report"] = (
    _chain(f"SELECT 'p' || no AS page, CASE WHEN {_LOST} THEN 'lost' || no ELSE {_NEXT} END AS next FROM ids")
    + "SELECT l.page, l.next, c.position, CASE WHEN c.position IS NULL THEN 'unreachable' "
      "WHEN l.next IS NULL THEN 'end' WHEN l.next NOT IN (SELECT page FROM links) THEN 'gap' "
      "ELSE 'chain' END AS status\nFROM links l LEFT JOIN chain c ON c.page = l.page")
_AS_OF = ", ".join(f"(DATE '{d}')" for d in C.ROLLING_AS_OF)
ORACLE["hist_agg_rolling"] = (
    _with(FX_HIST_FLAT, f"windows(as_of) AS (VALUES {_AS_OF})")
    + "SELECT as_of, code_station, latitude, longitude, grandeur_hydro_elab,\n  "
    + ",\n  ".join(f"quantile_disc(resultat_obs_elab, {f}) AS {c}" for f, c in zip(schemas.QUANTILE_FRACTIONS, _Q))
    + ",\n  min(date_obs_elab) AS minimum_date_window, max(date_obs_elab) AS maximum_date_window\n"
      "FROM windows JOIN fx_hist_flat ON date_obs_elab BETWEEN as_of - 729 AND as_of\n"
      "WHERE grandeur_hydro_elab = 'QmJ' AND resultat_obs_elab > 0\n"
      "GROUP BY as_of, code_station, latitude, longitude, grandeur_hydro_elab")

ORACLE["stream_latest_log"] = ORACLE["live_latest"]
ORACLE["stream_indicator_compacted"] = ORACLE["stream_indicator"]
_BROKEN = f"event_id % {C.BROKEN_EVERY} = 0"
ORACLE["live_quarantine"] = (
    "SELECT 'record' AS kind, CAST(NULL AS VARCHAR) AS line, "
    + ", ".join(f"{_LIVE_BASE_GIVEN[c]} AS {c}" for c in ("code_station", "date_obs", "resultat_obs"))
    + f", CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS BIGINT) AS n_bad FROM events WHERE NOT ({_BROKEN})\n"
      f"UNION ALL SELECT 'line', 'broken ' || event_id, NULL, NULL, NULL, NULL, NULL FROM events WHERE {_BROKEN}\n"
      f"UNION ALL SELECT 'counts', NULL, NULL, NULL, NULL, CAST(count(*) FILTER (WHERE NOT ({_BROKEN})) AS BIGINT), "
      f"CAST(count(*) FILTER (WHERE {_BROKEN}) AS BIGINT) FROM events")

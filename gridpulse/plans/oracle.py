"""The registered queries in SQL, for DuckDB over the same tables.

Instants are epoch microseconds, dates are text, and means are summed in
thousandths, as in the Spark queries.
"""

from __future__ import annotations

_ORIGIN = 1_704_067_200_000_000
_WIDTH = {"1min": 60_000_000, "15min": 900_000_000}
_RANGE = {"1min": 3_600_000_000, "15min": 6 * 3_600_000_000}
_KEEP = {"1min": "7 days", "15min": "1 year"}
_LATENESS = 120_000_000
_HOUSE = "click"
_SERVING = "house_id, window_start, window_end, avg_power_kw, max_power_kw, avg_pv_panel_kw, avg_ev_charging_kw"
_PANELS = {"power": "avg_power_kw", "pv": "avg_pv_panel_kw", "ev": "avg_ev_charging_kw"}

_METRICS = """CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS pv_panel_kw,
    CASE WHEN value >= 7.4 THEN CAST(7.4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ev_charging_kw,
    value AS power_kw, CAST(230 AS DOUBLE) AS voltage"""


def _readings(us: str) -> str:
    return f"m AS (SELECT event_id, event_type AS house_id, {_METRICS}, {us} AS us FROM events)"


_DENSE = _readings(f"{_ORIGIN} + (epoch_us(ts) - {_ORIGIN}) // 60")
_REAL = _readings("epoch_us(ts)")


def _mean(x: str) -> str:
    return f"CAST(SUM(CAST(ROUND({x} * 1000) AS BIGINT)) AS DOUBLE) / 1000 / COUNT({x}) AS avg_{x}"


def _exact_mean(x: str) -> str:
    """The doubles of the test readings are multiples of 2^-60, so their sum is exact in units of that; text turns into the nearest double."""
    unit = "CAST(1152921504606846976 AS DOUBLE)"
    return f"CAST(CAST(SUM(CAST({x} * {unit} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {unit} / COUNT({x}) AS avg_{x}"


def _local(us: str) -> str:
    return f"((make_timestamp({us}) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin')"


def _keys(us: str, day: str) -> str:
    return f"""CAST(CAST({_local(us)} AS DATE) AS VARCHAR) AS {day},
    CAST(EXTRACT(hour FROM {_local(us)}) AS INTEGER) AS hour"""


def _gold(grain: str, readings: str = _DENSE, source: str = "m", mean=_mean) -> str:
    """CTEs ending in g: all windows of a width."""
    start = f"us - us % {_WIDTH[grain]}"
    return f"""WITH {readings}, g AS (
  SELECT house_id, {start} AS window_start, {start} + {_WIDTH[grain]} AS window_end,
    {mean("power_kw")}, MAX(power_kw) AS max_power_kw, {mean("pv_panel_kw")}, {mean("ev_charging_kw")}
  FROM {source} GROUP BY house_id, {start})"""


def _with_keys(ctes: str, where: str = "TRUE") -> str:
    return f"{ctes} SELECT {_SERVING}, {_keys('window_start', 'event_date')} FROM g WHERE {where}"


def _closed(readings: str = "m") -> str:
    return f"window_end <= (SELECT MAX(us) FROM {readings}) - {_LATENESS}"


def _late(grain: str) -> str:
    """The late house keeps only windows still open when the others have been read."""
    width = _WIDTH[grain]
    seen = f"""{_DENSE}, kept AS (SELECT * FROM m WHERE house_id <> '{_HOUSE}'
    OR us - us % {width} + {width} > (SELECT MAX(us) FROM m WHERE house_id <> '{_HOUSE}') - {_LATENESS})"""
    return _with_keys(_gold(grain, seen, "kept"), _closed())


_CLEAN = f"""SELECT CAST(user_id AS VARCHAR) AS house_id, {_METRICS}, epoch_us(ts) AS event_time,
    {_keys("epoch_us(ts)", "dt")} FROM events"""
# Of three payloads per reading the one without a time goes, and of those of one house also the one without a house.
_NULL_KEYS = f"""SELECT event_type AS house_id, CASE WHEN i = 1 THEN pv_panel_kw END AS pv_panel_kw, CAST(NULL AS DOUBLE) AS ev_charging_kw, power_kw,
    CAST(NULL AS DOUBLE) AS voltage, epoch_us(ts) AS event_time, {_keys("epoch_us(ts)", "dt")}
FROM (SELECT *, {_METRICS} FROM events), (SELECT unnest([1, 2]) AS i) WHERE i = 2 OR event_type <> '{_HOUSE}'"""
_HOUR = "(EXTRACT(hour FROM ts) + EXTRACT(minute FROM ts) / 60 + FLOOR(EXTRACT(second FROM ts)) / 3600)"
_H = f"WITH p AS (SELECT event_id, value, {_HOUR} AS h FROM events)"


def _pv(size: int) -> str:
    return f"CASE WHEN h BETWEEN 7 AND 19 THEN {size} * GREATEST(0, SIN(PI() * (h - 7) / 12)) * 0.80 ELSE 0 END"


_EV = "CASE WHEN h - 18 >= 0 AND h - 18 < 1.5 THEN CAST(7.4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
_LOAD = """0.25 + EXP(-0.5 * POWER((h - 7.5) / 1.0, 2)) + 0.4 * EXP(-0.5 * POWER((h - 13.0) / 1.5, 2))
    + 1.6 * EXP(-0.5 * POWER((h - 19.5) / 1.5, 2))"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "silver_parse": f"""
SELECT CAST(user_id AS VARCHAR) AS house_id, replace(CAST(ts AS VARCHAR), ' ', 'T') || '+00:00' AS "timestamp",
    {_METRICS} FROM events
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), text, NULL, NULL, CAST(n_chars AS DOUBLE), NULL FROM documents
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM conversations""",
        "silver_clean": _CLEAN,
        "stream_silver": _CLEAN,
        "event_encode": f"WITH {_REAL} SELECT * EXCLUDE (event_id, us), us AS event_time FROM m",
        "layer_scan": f"SELECT dt, hour, COUNT(*) AS n_rows FROM ({_CLEAN}) GROUP BY dt, hour",
        "stream_progress": """SELECT 'silver' AS query, (SELECT COUNT(*) FROM events)
    + 2 * (SELECT COUNT(*) FROM documents) + (SELECT COUNT(*) FROM conversations) AS input_rows""",
        "silver_null_keys": _NULL_KEYS,
        "stream_houses": "SELECT DISTINCT event_type AS house_id FROM events ORDER BY 1",
        "stream_metrics": f"""
WITH c AS (SELECT (SELECT COUNT(*) FROM events) AS e, (SELECT COUNT(*) FROM events WHERE event_type = '{_HOUSE}') AS k,
    2 * (SELECT COUNT(*) FROM documents) + (SELECT COUNT(*) FROM conversations) AS bad),
r AS (SELECT CAST(user_id AS VARCHAR) AS house_id, epoch_us(ts) AS us FROM events
    UNION ALL SELECT house_id, event_time FROM ({_NULL_KEYS})),
w AS (SELECT DISTINCT house_id, us - us % {_WIDTH["1min"]} + {_WIDTH["1min"]} AS window_end FROM r),
closed AS (SELECT COUNT(*) AS n FROM w WHERE window_end <= (SELECT MAX(us) FROM r) - {_LATENESS})
SELECT 'silver' AS query, 4 * e + bad AS input_rows, k AS no_house, e + bad AS no_time, 0 AS late_rows, 3 * e - k AS written FROM c
UNION ALL SELECT 'gold_1min', 3 * e - k, NULL, NULL, 0, n FROM c, closed""",
        "stream_chain_15min": f"{_gold('15min')} SELECT {_SERVING} FROM g WHERE {_closed()}",
        "stream_all_layers": " UNION ALL ".join(
            f"SELECT '{grain}' AS grain, * FROM ({_gold(grain)} SELECT {_SERVING} FROM g WHERE {_closed()})"
            for grain in _WIDTH
        ),
        "profile_hour_frac": f"{_H} SELECT event_id, ROUND(h, 6) AS hour_frac FROM p",
        "profile_pv": f"""{_H} SELECT event_id, ROUND({_pv(6)}, 6) AS expected_pv_6_kw,
    ROUND({_pv(8)}, 6) AS expected_pv_8_kw FROM p""",
        "profile_ev": f"{_H} SELECT event_id, {_EV} AS expected_ev_kw FROM p",
        "profile_load": f"{_H} SELECT event_id, ROUND({_LOAD}, 6) AS expected_load_kw FROM p",
        "profile_net": f"""{_H} SELECT event_id, ROUND({_LOAD} + {_EV} - {_pv(6)}, 6) AS expected_power_kw,
    value AS power_kw FROM p""",
        "profile_deviation": f"""
WITH {_REAL}, h AS (SELECT m.*, {_HOUR} AS h FROM m JOIN events USING (event_id)),
s AS (SELECT house_id, CASE WHEN MAX(pv_panel_kw) > 6 THEN 8.0 ELSE 6.0 END AS size FROM m GROUP BY house_id),
g AS (SELECT house_id, CAST(FLOOR(h) AS INTEGER) AS hour_of_day, COUNT(*) AS n_readings, {_exact_mean('pv_panel_kw').removesuffix(' AS avg_pv_panel_kw')} AS pv, AVG({_pv(1)}) AS one,
    AVG(ev_charging_kw) - AVG({_EV}) AS ev, AVG(power_kw - ev_charging_kw + pv_panel_kw) - AVG({_LOAD}) AS load FROM h GROUP BY ALL)
SELECT house_id, hour_of_day, n_readings, pv AS pv_kw, ROUND(one * size, 6) AS expected_pv_kw,
    ROUND(pv - one * size, 6) AS pv_deviation_kw, ROUND(ev, 6) AS ev_deviation_kw, ROUND(load, 6) AS load_deviation_kw FROM g JOIN s USING (house_id)""",
        "net_balance": f"""WITH {_REAL}
SELECT event_id, ROUND(power_kw - ev_charging_kw + pv_panel_kw, 6) AS house_load_kw FROM m""",
        "measure_round": """SELECT event_id, CAST(printf('%.1f', value) AS DOUBLE) AS power_1,
    CAST(printf('%.3f', value / 16) AS DOUBLE) AS sixteenth_3 FROM events""",
    }
    for grain in _WIDTH:
        gold = _gold(grain)
        last = "(SELECT MAX(window_start) FROM g)"
        sql |= {
            f"gold_{grain}": _with_keys(gold),
            f"gold_avg_{grain}": _with_keys(_gold(grain, mean=_exact_mean)),
            f"stream_open_windows_{grain}": f"{gold} SELECT {_SERVING} FROM g WHERE NOT ({_closed()})",
            f"serving_{grain}": f"{gold} SELECT {_SERVING} FROM g",
            f"serving_replay_{grain}": f"{gold} SELECT {_SERVING} FROM g",
            f"house_list_{grain}": f"{gold} SELECT DISTINCT house_id FROM g ORDER BY house_id",
            f"panel_range_{grain}": f"""{gold} SELECT window_start AS time, avg_power_kw AS value FROM g
WHERE house_id = '{_HOUSE}' AND window_start >= {last} - {_RANGE[grain]} ORDER BY window_start""",
            f"dashboard_sql_{grain}": f"""{gold} SELECT window_start AS time, avg_power_kw AS value FROM g
WHERE house_id = '{_HOUSE}' ORDER BY window_start""",
            f"peek_{grain}": f"{gold} SELECT {_SERVING} FROM g ORDER BY house_id, window_start LIMIT 10",
            f"retention_{grain}": f"""{_gold(grain, _REAL)} SELECT {_SERVING} FROM g
WHERE window_start >= epoch_us(make_timestamp({last}) - INTERVAL '{_KEEP[grain]}')""",
            f"stream_gold_{grain}": _with_keys(gold, _closed()),
            f"stream_backlog_{grain}": _with_keys(gold, _closed()),
            f"stream_restart_{grain}": _with_keys(gold, _closed()),
            f"stream_late_{grain}": _late(grain),
            f"gold_salted_{grain}": f"""SELECT event_date, hour, COUNT(*) AS n_rows, COUNT(*) AS n_windows,
    MAX(window_start) AS last_window, TRUE AS files_bounded FROM ({_with_keys(gold)}) GROUP BY event_date, hour""",
            f"gold_files_{grain}": f"""SELECT event_date, hour, CAST(1 AS BIGINT) AS n_files, COUNT(*) AS n_rows
FROM ({_with_keys(gold)}) GROUP BY event_date, hour""",
        }
        sql[f"stored_peek_{grain}"] = sql[f"peek_{grain}"]
        sql[f"stored_range_{grain}"] = sql[f"panel_range_{grain}"]
        sql[f"stored_sql_{grain}"] = sql[f"dashboard_sql_{grain}"]
        sql[f"expire_{grain}"] = sql[f"retention_{grain}"]
        sql[f"stream_live_{grain}"] = f"{gold} SELECT {_SERVING} FROM g WHERE {_closed()}"
        sql |= {
            f"{kind}_{name}_{grain}": f"""{gold} SELECT window_start AS time, {column} AS value FROM g
WHERE house_id = '{_HOUSE}' ORDER BY window_start"""
            for name, column in _PANELS.items()
            for kind in ("panel", "stored_panel")
        }
    return sql

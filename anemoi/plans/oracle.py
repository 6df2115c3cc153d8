"""The same catalogue as ANSI-ish SQL for DuckDB, over the same Parquet views.

Used by the driver's correctness check and by ``scripts/oracle_check.py``.
Computed doubles are rounded to 6 places, like the Spark side.
"""

from __future__ import annotations

_TELEMETRY = """
telemetry AS (
  SELECT ts AS "timestamp", user_id AS turbine_id,
         NULLIF(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS wind_speed,
         NULLIF(CAST(event_id % 360 AS DOUBLE), 0) AS wind_direction,
         CASE WHEN event_type = 'error' THEN NULL ELSE NULLIF(value, 0) END AS power_output
  FROM events)"""

_TWO_SIDED = """
telemetry AS (
  SELECT ts AS "timestamp", user_id AS turbine_id,
         NULLIF(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS wind_speed,
         NULLIF(CAST(event_id % 360 AS DOUBLE), 0) AS wind_direction,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE NULLIF(CASE WHEN user_id % 2 = 1 THEN 100.0 - value ELSE value END, 0) END
           AS power_output
  FROM events)"""

_ANOMALIES = _TELEMETRY + """,
b AS (SELECT avg(power_output) - 2.0 * stddev_pop(power_output) AS lo,
             avg(power_output) + 2.0 * stddev_pop(power_output) AS hi FROM telemetry),
anomalies AS (
  SELECT t.* FROM telemetry t, b WHERE t.power_output < b.lo OR t.power_output > b.hi)"""

_ELIGIBLE = _ANOMALIES + """,
elig AS (
  SELECT t.* FROM telemetry t
  WHERE t.wind_speed IS NOT NULL AND t.wind_direction IS NOT NULL AND t.power_output IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM anomalies a
                    WHERE a."timestamp" = t."timestamp" AND a.turbine_id = t.turbine_id))"""

_PROFILE = _ELIGIBLE + """,
anchor AS (SELECT max("timestamp") AS mx FROM telemetry),
periods AS (SELECT * FROM (VALUES ('full_dataset', NULL), ('last_4_weeks', 28), ('last_2_weeks', 14),
                                 ('last_1_week', 7), ('last_1_day', 1)) p(period, days)),
pe AS (SELECT p.period, e.* FROM elig e, periods p, anchor
       WHERE p.days IS NULL OR e."timestamp" >= anchor.mx - to_days(CAST(p.days AS INTEGER))),
long AS (
  SELECT period, 'wind_speed' AS measure, wind_speed AS value FROM pe
  UNION ALL SELECT period, 'wind_direction', wind_direction FROM pe
  UNION ALL SELECT period, 'power_output', power_output FROM pe),
agg AS (SELECT period, measure, avg(value) AS mean, median(value) AS median
        FROM long GROUP BY period, measure),
md AS (SELECT period, measure, value AS mode FROM (
         SELECT period, measure, value,
                row_number() OVER (PARTITION BY period, measure ORDER BY count(*) DESC, value) AS rn
         FROM long GROUP BY period, measure, value) WHERE rn = 1),
profile AS (
  SELECT a.period,
""" + ",\n".join(
    f"         max(CASE WHEN a.measure = '{m}' THEN {s} END) AS {m}_{s}"
    for m in ("wind_speed", "wind_direction", "power_output") for s in ("mean", "median", "mode")
) + """
  FROM agg a JOIN md m ON a.period = m.period AND a.measure = m.measure
  GROUP BY a.period)"""

_CLEAN = _PROFILE + """,
fill AS (SELECT wind_speed_median AS ws, wind_direction_median AS wd, power_output_mean AS po
         FROM profile WHERE period = 'full_dataset'),
clean AS (
  SELECT t."timestamp", t.turbine_id,
         coalesce(t.wind_speed, (SELECT ws FROM fill)) AS wind_speed,
         coalesce(t.wind_direction, (SELECT wd FROM fill)) AS wind_direction,
         coalesce(t.power_output, (SELECT po FROM fill)) AS power_output
  FROM telemetry t
  WHERE NOT EXISTS (SELECT 1 FROM anomalies a
                    WHERE a."timestamp" = t."timestamp" AND a.turbine_id = t.turbine_id))"""

_LINE_COLS = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _line_pick(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_COLS)
    return f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
      FROM lineitem) WHERE rn = 1"""


ORACLE_SQL = {
    "normalise_missing": """
SELECT l_orderkey, l_linenumber,
       NULLIF(CASE WHEN isnan(l_quantity) THEN NULL ELSE l_quantity END, 0) AS l_quantity,
       NULLIF(CASE WHEN isnan(l_discount) THEN NULL ELSE l_discount END, 0) AS l_discount,
       NULLIF(CASE WHEN isnan(l_tax) THEN NULL ELSE l_tax END, 0) AS l_tax
FROM lineitem""",
    "valid_rows": """
WITH txt AS (
  SELECT CASE WHEN event_type = 'error' THEN 'n/a ' || CAST(ts AS VARCHAR)
              ELSE CAST(ts AS VARCHAR) END AS ts_text,
         CAST(user_id AS VARCHAR) AS id_text,
         json_extract_string(props, '$.k') AS ws_text,
         CAST(event_id % 360 AS VARCHAR) AS wd_text,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS VARCHAR) END AS po_text
  FROM events)
SELECT TRY_CAST(ts_text AS TIMESTAMP) AS "timestamp", TRY_CAST(id_text AS BIGINT) AS turbine_id,
       NULLIF(TRY_CAST(ws_text AS DOUBLE), 0) AS wind_speed,
       NULLIF(TRY_CAST(wd_text AS DOUBLE), 0) AS wind_direction,
       NULLIF(TRY_CAST(po_text AS DOUBLE), 0) AS power_output
FROM txt
WHERE TRY_CAST(ts_text AS TIMESTAMP) IS NOT NULL AND TRY_CAST(id_text AS BIGINT) IS NOT NULL""",
    "high_water_mark": """
SELECT max(ts) AS high_water_mark FROM events WHERE ts < TIMESTAMP '2024-01-21 00:00:00'""",
    "baseline_bounds": "WITH" + _TELEMETRY + """,
m AS (SELECT avg(power_output) AS mean_power, stddev_pop(power_output) AS std_power FROM telemetry)
SELECT round(mean_power, 6) AS mean_power, round(std_power, 6) AS std_power,
       round(mean_power - 2.0 * std_power, 6) AS lower_bound,
       round(mean_power + 2.0 * std_power, 6) AS upper_bound
FROM m WHERE mean_power IS NOT NULL AND std_power > 0""",
    "anomalies_full": "WITH" + _ANOMALIES + """
SELECT * FROM anomalies""",
    "anomalies_incremental": "WITH" + _TWO_SIDED + """,
prev AS (SELECT * FROM telemetry WHERE "timestamp" < TIMESTAMP '2024-01-21 00:00:00'),
b AS (SELECT avg(power_output) - 2.0 * stddev_pop(power_output) AS lo,
             avg(power_output) + 2.0 * stddev_pop(power_output) AS hi,
             max("timestamp") AS cutoff FROM prev)
SELECT t.* FROM telemetry t, b
WHERE t.power_output < b.lo OR (t.power_output > b.hi AND t."timestamp" > b.cutoff)""",
    "eligible_rows": "WITH" + _ELIGIBLE + """
SELECT * FROM elig""",
    "period_profile": "WITH" + _PROFILE + """
SELECT period, """ + ", ".join(
        f"round({m}_{s}, 6) AS {m}_{s}"
        for m in ("wind_speed", "wind_direction", "power_output") for s in ("mean", "median", "mode")
    ) + " FROM profile",
    "latest_profile": """
SELECT o_orderpriority, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""",
    "clean": "WITH" + _CLEAN + """
SELECT "timestamp", turbine_id, round(wind_speed, 6) AS wind_speed,
       round(wind_direction, 6) AS wind_direction, round(power_output, 6) AS power_output
FROM clean""",
    "daily_summary": "WITH" + _CLEAN + """
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS day, turbine_id,
       round(min(power_output), 6) AS min_power_output,
       round(max(power_output), 6) AS max_power_output,
       round(avg(power_output), 6) AS avg_power_output
FROM clean GROUP BY CAST("timestamp" AS DATE), turbine_id""",
    "anomaly_counts_long": "WITH" + _ANOMALIES + """
SELECT strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS day, turbine_id, count(*) AS anomaly_count
FROM anomalies GROUP BY CAST("timestamp" AS DATE), turbine_id""",
    "anomaly_pivot": "WITH" + _ANOMALIES + """,
c AS (SELECT CAST("timestamp" AS DATE) AS d, turbine_id AS i, count(*) AS n FROM anomalies GROUP BY ALL)
SELECT strftime(x.d, '%Y-%m-%d') AS day, 'Turbine_ID_' || CAST(y.i AS VARCHAR) AS "column", coalesce(c.n, 0) AS n
FROM (SELECT DISTINCT d FROM c) x CROSS JOIN (SELECT DISTINCT i FROM c) y LEFT JOIN c ON c.d = x.d AND c.i = y.i""",
    "distinct_ids": "WITH" + _ANOMALIES + """
SELECT DISTINCT turbine_id FROM anomalies""",
    "upsert": _line_pick("DESC"),
    "insert_ignore": _line_pick("ASC"),
    "latest_per_key": """
SELECT user_id, ts, event_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
    "feed_state": """
SELECT event_type AS file_name, arg_max(ts, event_id) AS last_record_timestamp,
       count(*) AS last_record_csv_row_number
FROM events GROUP BY event_type""",
    "tail_scan": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events),
o AS (SELECT event_type, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-21 00:00:00') AS off
      FROM events GROUP BY event_type)
SELECT r.event_id, r.ts, r.user_id, r.event_type, r.value
FROM r JOIN o ON r.event_type = o.event_type WHERE r.rn > o.off""",
}
# the paths of a daily run give the same rows
ORACLE_SQL["bounds_from_stats"] = ORACLE_SQL["baseline_bounds"]
ORACLE_SQL["profile_from_day_counts"] = ORACLE_SQL["period_profile"]

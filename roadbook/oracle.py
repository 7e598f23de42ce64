"""The same results in SQL, for an independent engine to compare with.

Every statement is one chain of CTEs over the test tables. It is written on its
own terms (integer half-up division instead of decimals, say), not generated
from the Spark code.
"""

from __future__ import annotations

HEALTH_AS_OF = "DATE '2001-08-15'"
EFFICIENCY_AS_OF = "DATE '2024-01-30'"


def _id(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest(length({text}), {width}) AS INTEGER), '0')"


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator hundredths, rounded half up; both non-negative integers."""
    n, q = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"CAST(((2 * {n} + {q}) // (2 * {q})) AS DOUBLE) / 100.0e0"


def _mean(column: str, digits: int = 2) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,{digits}))) AS DOUBLE) / count({column})"


_VEHICLE = "(user_id % 20)"

GPS_COLUMNS = f"""
    {_id('EV-', 'event_id', 7)} AS event_id,
    {_id('VH-', _VEHICLE + ' + 1', 6)} AS vehicle_id,
    {_id('RT-', f'({_VEHICLE} + (event_id % 3) * 9) % 27 + 1', 4)} AS route_id,
    29.45e0 + (event_id * 7919 % 7001) / 10000.0e0 AS lat,
    -95.85e0 + (event_id * 104729 % 8001) / 10000.0e0 AS lon,
    (CAST(round(value * 100) AS BIGINT) % 801) / 10.0e0 AS speed_mph,
    CAST(event_id * 37 % 360 AS INTEGER) AS heading_deg,
    CAST(ts AS TIMESTAMP) AS event_ts,
    CAST(ts AS DATE) AS event_date"""

CTES = f"""
raw_gps_events AS (SELECT {GPS_COLUMNS} FROM events),
raw_routes AS (
  SELECT {_id('RT-', 'n_nationkey + 1', 4)} AS route_id,
    n_name AS route_name, r_name AS zone,
    'District-' || CAST(n_nationkey % 5 + 1 AS VARCHAR) AS district,
    CAST(4 + n_nationkey % 17 AS INTEGER) AS total_stops,
    TIMESTAMP '2023-01-01 06:00:00' + to_days(CAST(n_nationkey AS INTEGER)) AS created_at
  FROM nation JOIN region ON n_regionkey = r_regionkey),
raw_vehicles AS (
  SELECT {_id('VH-', 'p_partkey + 1', 6)} AS vehicle_id,
    p_brand AS make, p_name AS model,
    CAST(2015 + p_size % 10 AS INTEGER) AS "year",
    CASE p_partkey % 3 WHEN 0 THEN 'light' WHEN 1 THEN 'medium' ELSE 'heavy' END AS vehicle_class,
    CASE WHEN p_partkey % 20 < 15 THEN 'active' WHEN p_partkey % 20 < 18 THEN 'inactive'
         ELSE 'maintenance' END AS status,
    {_id('VIN', 'p_partkey * 31 + 7', 12)} AS vin,
    {_id('TX-', 'p_partkey * 17 % 100000', 5)} AS license_plate
  FROM part),
raw_stops AS (SELECT {_id('ST-', 's_suppkey + 1', 5)} AS stop_id FROM supplier),
raw_maintenance_logs AS (
  SELECT {_id('ML-', 'o_orderkey + 1', 6)} AS log_id,
    {_id('VH-', 'o_custkey + 1', 6)} AS vehicle_id,
    o_orderpriority AS service_type,
    CAST(o_orderdate AS DATE) AS service_date,
    o_totalprice / 100.0e0 AS cost_usd,
    CAST(5000 + o_orderkey * 41 % 245001 AS INTEGER) AS mileage_at_service,
    'Tech-' || CAST(o_orderkey % 40 + 1 AS VARCHAR) AS technician,
    'order status ' || o_orderstatus AS notes
  FROM orders),
stg_gps AS (
  SELECT * FROM raw_gps_events
  WHERE lat BETWEEN 29.5e0 AND 30.1e0 AND lon BETWEEN -95.8e0 AND -95.1e0),
lagged AS (
  SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(event_ts) OVER w AS prev_ts
  FROM stg_gps
  WINDOW w AS (PARTITION BY vehicle_id, route_id, event_date ORDER BY event_ts, event_id, lat, lon)),
measured AS (
  SELECT *,
    2 * 3958.8e0 * asin(sqrt(pow(sin(radians((lat - prev_lat) / 2)), 2)
      + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin(radians((lon - prev_lon) / 2)), 2)))
      AS miles,
    date_diff('second', prev_ts, event_ts) AS seconds
  FROM lagged),
segments AS (
  SELECT m.event_id, m.vehicle_id, m.route_id, r.route_name, r.zone, r.district,
    m.lat, m.lon, m.speed_mph, m.heading_deg, m.event_ts, m.event_date,
    CASE WHEN m.prev_lat IS NULL THEN 0e0 ELSE m.miles END AS segment_distance_miles,
    CASE WHEN m.speed_mph < 5 THEN 1 ELSE 0 END AS idle_flag,
    m.seconds / 60.0e0 AS elapsed_mins, m.seconds
  FROM measured m LEFT JOIN raw_routes r ON m.route_id = r.route_id),
daily_sums AS (
  SELECT vehicle_id, event_date,
    count(DISTINCT route_id) AS trips_count,
    sum(segment_distance_miles) AS miles,
    sum(CAST(round(speed_mph * 10) AS BIGINT)) AS tenths,
    count(speed_mph) AS speeds,
    sum(CASE WHEN idle_flag = 1 THEN seconds ELSE 0 END) AS idle_s,
    sum(seconds) AS active_s,
    count(*) AS event_count
  FROM segments GROUP BY vehicle_id, event_date),
daily AS (
  SELECT vehicle_id, event_date, trips_count,
    round(miles, 4) AS total_miles,
    {_half_up('10 * tenths', 'speeds')} AS avg_speed_mph,
    {_half_up('100 * idle_s', '60')} AS total_idle_mins,
    {_half_up('100 * active_s', '60')} AS total_active_mins,
    CASE WHEN active_s > 0 THEN {_half_up('10000 * idle_s', 'active_s')} ELSE 0e0 END AS idle_pct,
    event_count
  FROM daily_sums),
route_sums AS (
  SELECT route_id, route_name, zone, district, event_date AS segment_date,
    count(DISTINCT vehicle_id) AS vehicles_on_route,
    sum(CAST(round(speed_mph * 10) AS BIGINT)) AS tenths, count(speed_mph) AS speeds,
    sum(segment_distance_miles) AS miles,
    sum(idle_flag) AS idle,
    count(*) AS total_events
  FROM segments GROUP BY ALL),
efficiency AS (
  SELECT route_id, route_name, zone, district, segment_date, vehicles_on_route,
    {_half_up('10 * tenths', 'speeds')} AS avg_speed,
    round(miles, 4) AS total_miles,
    {_half_up('10000 * idle', 'total_events')} AS avg_idle_pct,
    total_events,
    CASE WHEN speeds > 0 THEN
      {_half_up('(10000 * total_events - 5000 * idle) * speeds - 3 * total_events * greatest(0, 350 * speeds - tenths)',
                'total_events * speeds')} END AS efficiency_score
  FROM route_sums),
services AS (
  SELECT vehicle_id, max(service_date) AS last_service_date,
    sum(CASE WHEN year(service_date) = year({HEALTH_AS_OF})
             THEN CAST(cost_usd AS DECIMAL(18,4)) ELSE 0 END) AS cost,
    count(*) AS total_service_events
  FROM raw_maintenance_logs GROUP BY vehicle_id),
health AS (
  SELECT v.vehicle_id, v.make, v.model, v."year", v.vehicle_class, v.status,
    s.last_service_date,
    CAST(date_diff('day', s.last_service_date, {HEALTH_AS_OF}) AS INTEGER) AS days_since_service,
    CAST(round(s.cost, 2) AS DOUBLE) AS total_cost_ytd,
    s.total_service_events,
    CASE WHEN date_diff('day', s.last_service_date, {HEALTH_AS_OF}) > 90 THEN 'high'
         WHEN date_diff('day', s.last_service_date, {HEALTH_AS_OF}) > 60 THEN 'medium'
         ELSE 'low' END AS maintenance_urgency
  FROM raw_vehicles v LEFT JOIN services s ON v.vehicle_id = s.vehicle_id),
month_sums AS (
  SELECT vehicle_id, CAST(date_trunc('month', event_date) AS DATE) AS "month",
    sum(CAST(round(avg_speed_mph * 100) AS BIGINT)) AS speed_c, count(avg_speed_mph) AS speed_n,
    sum(CAST(round(idle_pct * 100) AS BIGINT)) AS idle_c,
    sum(CAST(total_miles AS DECIMAL(18,4))) AS miles,
    sum(trips_count) AS trips,
    sum(CAST(round(total_active_mins * 100) AS BIGINT)) AS active_c,
    count(total_active_mins) AS active_n,
    count(DISTINCT event_date) AS days
  FROM daily GROUP BY ALL),
performance AS (
  SELECT m.vehicle_id, v.make, v.model, v.vehicle_class, m."month",
    {_half_up('speed_c', 'speed_n')} AS avg_speed,
    {_half_up('idle_c', 'days')} AS idle_pct,
    CAST(round(miles, 2) AS DOUBLE) AS total_miles,
    CAST(trips AS BIGINT) AS total_trips,
    days AS active_days,
    {_half_up('active_c', 'nullif(active_n, 0)')} AS avg_active_mins_per_day,
    CASE WHEN speed_n > 0 THEN
      {_half_up('630000 * days * speed_n + 40 * days * least(speed_c, 4500 * speed_n) - 27 * speed_n * idle_c',
                '90 * days * speed_n')} END AS safety_score
  FROM month_sums m LEFT JOIN raw_vehicles v ON m.vehicle_id = v.vehicle_id),
landed AS (
  SELECT {GPS_COLUMNS.replace('AS event_id', 'AS clean_id').replace('AS route_id', 'AS clean_route')
                     .replace('AS speed_mph', 'AS clean_speed')
                     .replace('AS heading_deg', 'AS clean_heading')},
    CASE WHEN event_id % 40 = 7 THEN '' ELSE {_id('EV-', 'event_id', 7)} END AS event_id,
    CASE event_id % 70 WHEN 11 THEN {_id('RT-', f'({_VEHICLE} + (event_id % 3) * 9) % 27 + 1', 4)} || '-99999999999999999999'
         WHEN 12 THEN 'RT-"7" a, b' ELSE {_id('RT-', f'({_VEHICLE} + (event_id % 3) * 9) % 27 + 1', 4)} END AS route_id,
    CASE event_id % 50 WHEN 0 THEN 'bad' WHEN 1 THEN 'NULL' WHEN 2 THEN '' WHEN 3 THEN 'null' WHEN 4 THEN '1e15'
         WHEN 5 THEN 'NaN' WHEN 6 THEN '-Infinity' WHEN 7 THEN '1e300'
         ELSE CAST(event_id % 80 AS VARCHAR) || '.5' END AS speed_mph,
    CASE WHEN event_id % 60 = 5 THEN '12.x' ELSE CAST(event_id % 360 AS VARCHAR) END AS heading_deg,
    event_id % 70 IN (9, 10) AS malformed
  FROM events),
parsed AS (
  SELECT *,
    CASE WHEN malformed THEN 'malformed line'
         WHEN event_id IN ('', 'NULL', 'null') THEN 'missing event_id'
         WHEN length(route_id) > 20 THEN 'too long route_id'
         WHEN speed_mph NOT IN ('', 'NULL', 'null')
           AND NOT coalesce(isfinite(try_cast(speed_mph AS DOUBLE)), false) THEN 'bad speed_mph'
         WHEN abs(try_cast(speed_mph AS DOUBLE)) > 1e7 THEN 'out of bounds speed_mph'
         WHEN heading_deg NOT IN ('', 'NULL', 'null') AND try_cast(heading_deg AS INTEGER) IS NULL
           THEN 'bad heading_deg' END AS reason
  FROM landed)
"""

_CLASSES = "'light', 'medium', 'heavy'"
_STATUSES = "'active', 'inactive', 'maintenance'"
_LEVELS = "'low', 'medium', 'high'"

# The declared checks of each table.
# table -> (CTE, not-null columns, unique columns, [(column, allowed)], [(check, column, failing)])
_CHECKED = {
    "raw.routes": (
        "raw_routes",
        ["route_id", "zone", "district"],
        ["route_id"],
        [],
        [("positive", "total_stops", 'total_stops <= 0')],
    ),
    "raw.vehicles": (
        "raw_vehicles",
        ["vehicle_id"],
        ["vehicle_id"],
        [("vehicle_class", _CLASSES), ("status", _STATUSES)],
        [("range", "year", '"year" NOT BETWEEN 2010 AND 2025')],
    ),
    "raw.gps_events": (
        "raw_gps_events",
        ["event_id", "vehicle_id", "route_id", "speed_mph"],
        ["event_id"],
        [],
        [],
    ),
    "raw.maintenance_logs": (
        "raw_maintenance_logs",
        ["log_id", "vehicle_id", "cost_usd"],
        ["log_id"],
        [],
        [("positive", "cost_usd", 'cost_usd <= 0'),
         ("positive", "mileage_at_service", 'mileage_at_service <= 0')],
    ),
    "silver.stg_routes": (
        "raw_routes",
        ["route_id", "zone", "district", "total_stops"],
        ["route_id"],
        [],
        [],
    ),
    "silver.stg_vehicles": (
        "raw_vehicles",
        ["vehicle_id", "vehicle_class", "status"],
        ["vehicle_id"],
        [("vehicle_class", _CLASSES), ("status", _STATUSES)],
        [],
    ),
    "silver.stg_gps_events": (
        "stg_gps",
        ["event_id", "vehicle_id", "route_id", "lat", "lon", "speed_mph", "event_date"],
        ["event_id"],
        [],
        [("range", "lat", 'lat NOT BETWEEN 29.5e0 AND 30.1e0'),
         ("range", "lon", 'lon NOT BETWEEN -95.8e0 AND -95.1e0'),
         ("range", "speed_mph", 'speed_mph NOT BETWEEN 0 AND 120')],
    ),
    "silver.stg_maintenance": (
        "raw_maintenance_logs",
        ["log_id", "vehicle_id", "service_type", "service_date", "cost_usd"],
        ["log_id"],
        [],
        [],
    ),
    "silver.int_route_segments": (
        "segments",
        ["event_id", "vehicle_id", "route_id", "event_date", "speed_mph", "segment_distance_miles"],
        ["event_id"],
        [("idle_flag", "0, 1")],
        [],
    ),
    "silver.int_vehicle_daily_stats": (
        "daily",
        ["vehicle_id", "event_date", "trips_count", "total_miles", "idle_pct"],
        [],
        [],
        [],
    ),
    "gold.mart_route_efficiency": (
        "efficiency",
        ["route_id", "segment_date", "avg_speed", "total_miles", "avg_idle_pct", "vehicles_on_route",
         "efficiency_score"],
        [],
        [],
        [("range", "efficiency_score", 'efficiency_score NOT BETWEEN 0 AND 100')],
    ),
    "gold.mart_fleet_health": (
        "health",
        ["vehicle_id", "vehicle_class", "maintenance_urgency"],
        ["vehicle_id"],
        [("vehicle_class", _CLASSES), ("maintenance_urgency", _LEVELS)],
        [],
    ),
    "gold.mart_driver_performance": (
        "performance",
        ["vehicle_id", "month", "avg_speed", "idle_pct", "total_miles", "safety_score"],
        [],
        [],
        [("range", "safety_score", 'safety_score NOT BETWEEN 0 AND 100')],
    ),
}


def _count_where(table: str, cte: str, check: str, column: str, failing: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"count(*) FILTER (WHERE {failing}) AS failing_rows FROM {cte}")


def _checks(*kinds: str) -> str:
    parts = []
    for table, (cte, not_null, unique, accepted, ranges) in _CHECKED.items():
        if "not_null" in kinds:
            parts += [_count_where(table, cte, "not_null", c, f'"{c}" IS NULL') for c in not_null]
        if "accepted_values" in kinds:
            parts += [_count_where(table, cte, "accepted_values", c, f"{c} NOT IN ({values})")
                      for c, values in accepted]
        if "range" in kinds:
            parts += [_count_where(table, cte, check, c, failing) for check, c, failing in ranges]
        if "unique" in kinds:
            parts += [_count_where(
                table, f"(SELECT count(*) AS n FROM {cte} WHERE {c} IS NOT NULL GROUP BY {c}) AS g",
                "unique", c, "n > 1") for c in unique]
    return ("SELECT table_name, check_name, column_name, failing_rows, failing_rows = 0 AS passed "
            "FROM (" + " UNION ALL ".join(parts) + ") AS checks")


_IN_WINDOW = f"segment_date BETWEEN {EFFICIENCY_AS_OF} - 30 AND {EFFICIENCY_AS_OF}"

SELECTS: dict[str, str] = {
    "stg_routes": "SELECT * FROM raw_routes",
    "stg_vehicles": "SELECT * FROM raw_vehicles",
    "stg_maintenance": "SELECT * FROM raw_maintenance_logs",
    "stg_gps_events": "SELECT * FROM stg_gps",
    "gps_lag_features": "SELECT event_id, vehicle_id, route_id, event_date, event_ts, "
                        "prev_lat, prev_lon, prev_ts FROM lagged",
    "haversine_miles": "SELECT event_id, round(miles, 9) AS miles FROM measured",
    "segments_enriched": "SELECT g.event_id, g.vehicle_id, g.route_id, r.route_name, r.zone, "
                         "r.district, g.event_ts FROM stg_gps g "
                         "LEFT JOIN raw_routes r ON g.route_id = r.route_id",
    "int_route_segments": "SELECT event_id, vehicle_id, route_id, route_name, zone, district, lat, "
                          "lon, speed_mph, heading_deg, event_ts, event_date, "
                          "round(segment_distance_miles, 9) AS segment_distance_miles, "
                          "idle_flag, elapsed_mins FROM segments",
    "int_vehicle_daily_stats": "SELECT * FROM daily",
    "mart_route_efficiency": "SELECT * FROM efficiency",
    "mart_fleet_health": "SELECT * FROM health",
    "mart_driver_performance": "SELECT * FROM performance",
    "efficiency_score": "SELECT route_id, segment_date, efficiency_score FROM efficiency",
    "safety_score": 'SELECT vehicle_id, "month", safety_score FROM performance',
    "urgency_bucket": f"""
        SELECT log_id, CAST(date_diff('day', service_date, {HEALTH_AS_OF}) AS INTEGER) AS days_since,
          CASE WHEN date_diff('day', service_date, {HEALTH_AS_OF}) > 90 THEN 'high'
               WHEN date_diff('day', service_date, {HEALTH_AS_OF}) > 60 THEN 'medium'
               ELSE 'low' END AS urgency
        FROM raw_maintenance_logs""",
    "vq_top_idle_routes_last_week": f"""
        SELECT route_id, route_name, zone, {_mean('avg_idle_pct')} AS avg_idle_pct
        FROM efficiency WHERE segment_date >= {EFFICIENCY_AS_OF} - 7
        GROUP BY route_id, route_name, zone
        ORDER BY 4 DESC NULLS FIRST, route_id NULLS LAST LIMIT 10""",
    "vq_vehicles_overdue_maintenance": """
        SELECT vehicle_id, make, model, vehicle_class, last_service_date, days_since_service,
          maintenance_urgency
        FROM health WHERE maintenance_urgency IN ('medium', 'high')
        ORDER BY days_since_service DESC NULLS FIRST, vehicle_id""",
    "vq_avg_speed_by_zone": f"""
        SELECT zone, {_mean('avg_speed')} AS avg_speed_mph FROM efficiency GROUP BY zone""",
    "vq_monthly_fleet_cost": """
        SELECT vehicle_class,
          CAST(sum(CAST(total_cost_ytd AS DECIMAL(18,2))) AS DOUBLE) AS total_cost_usd
        FROM health GROUP BY vehicle_class""",
    "vq_lowest_efficiency_routes": f"""
        SELECT route_id, route_name, zone, {_mean('efficiency_score')} AS avg_efficiency
        FROM efficiency WHERE segment_date >= CAST(date_trunc('month', {EFFICIENCY_AS_OF}) AS DATE)
        GROUP BY route_id, route_name, zone
        ORDER BY 4 ASC NULLS LAST, route_id NULLS LAST LIMIT 10""",
    "dash_route_options": "SELECT DISTINCT route_id FROM efficiency",
    "dash_efficiency": f"""
        SELECT segment_date, route_id, zone, avg_speed, avg_idle_pct, total_miles,
          vehicles_on_route, efficiency_score
        FROM efficiency WHERE {_IN_WINDOW}""",
    "dash_fleet_health": f"""
        SELECT vehicle_id, make, model, vehicle_class, status, last_service_date,
          days_since_service, total_cost_ytd, maintenance_urgency
        FROM health WHERE vehicle_class IN ({_CLASSES})""",
    "dash_selected_classes": """
        SELECT vehicle_id, make, model, vehicle_class, status, last_service_date,
          days_since_service, total_cost_ytd, maintenance_urgency
        FROM health WHERE vehicle_class IN ('light', 'heavy')""",
    "dash_selected_routes": f"""
        SELECT segment_date, route_id, zone, avg_speed, avg_idle_pct, total_miles,
          vehicles_on_route, efficiency_score
        FROM efficiency WHERE {_IN_WINDOW} AND route_id IN ('RT-0002', 'RT-0026', 'RT-0005')""",
    "metric_where": f"""
        SELECT zone, {_mean('avg_speed')} AS avg_speed, CAST(sum(vehicles_on_route) AS BIGINT) AS vehicles_on_route
        FROM efficiency WHERE zone IN ('ASIA', 'EUROPE') AND segment_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        GROUP BY zone""",
    "dash_kpis": f"""
        SELECT
          (SELECT count(DISTINCT route_id) FROM efficiency WHERE {_IN_WINDOW}) AS active_routes,
          (SELECT ((2 * c + 10 * n) // (20 * n)) / 10.0e0
           FROM (SELECT sum(CAST(round(avg_speed * 100) AS BIGINT)) AS c, count(avg_speed) AS n
                 FROM efficiency WHERE {_IN_WINDOW}) AS s) AS avg_speed,
          (SELECT ((2000 * a + n) // (2 * n)) / 10.0e0
           FROM (SELECT count(*) FILTER (WHERE status = 'active') AS a, count(*) AS n
                 FROM health) AS f) AS fleet_utilisation,
          (SELECT count(*) FROM health WHERE maintenance_urgency IN ('medium', 'high'))
            AS maintenance_alerts""",
    "dash_daily_trend": f"""
        SELECT segment_date, {_mean('avg_speed')} AS avg_speed, {_mean('avg_idle_pct')} AS avg_idle_pct
        FROM efficiency WHERE {_IN_WINDOW} GROUP BY segment_date""",
    "dash_urgency_counts": """
        SELECT u.urgency, count(h.vehicle_id) AS vehicles
        FROM (VALUES ('low'), ('medium'), ('high')) AS u(urgency)
        LEFT JOIN health h ON h.maintenance_urgency = u.urgency GROUP BY u.urgency""",
    "dash_top_urgent": """
        SELECT vehicle_id, make, model, days_since_service, maintenance_urgency
        FROM health WHERE maintenance_urgency = 'high'
        ORDER BY days_since_service DESC NULLS FIRST, vehicle_id LIMIT 10""",
    "metric_by_zone": f"""
        SELECT zone, {_mean('avg_speed')} AS avg_speed,
          CAST(sum(CAST(total_miles AS DECIMAL(18,4))) AS DOUBLE) AS total_miles,
          {_mean('avg_idle_pct')} AS avg_idle_pct,
          CAST(sum(vehicles_on_route) AS BIGINT) AS vehicles_on_route,
          {_mean('efficiency_score')} AS efficiency_score
        FROM efficiency GROUP BY zone""",
    "metric_by_vehicle_class": f"""
        SELECT vehicle_class, {_mean('days_since_service', 0)} AS days_since_service,
          CAST(sum(CAST(total_cost_ytd AS DECIMAL(18,2))) AS DOUBLE) AS total_cost_ytd
        FROM health GROUP BY vehicle_class""",
    "metric_by_month": f"""
        SELECT "month", {_mean('avg_speed')} AS avg_speed, {_mean('idle_pct')} AS idle_pct,
          CAST(sum(CAST(total_miles AS DECIMAL(18,2))) AS DOUBLE) AS total_miles,
          {_mean('safety_score')} AS safety_score
        FROM performance GROUP BY "month" """,
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_accepted_values": _checks("accepted_values"),
    "dq_range": _checks("range"),
    "dq_report": _checks("not_null", "unique", "accepted_values", "range"),
    "dq_unique_after_reload": """
        SELECT 'raw.gps_events' AS table_name, count(*) AS failing_rows
        FROM (SELECT event_id FROM reloaded WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)
        UNION ALL
        SELECT 'silver.stg_gps_events', count(*)
        FROM (SELECT event_id FROM reloaded WHERE event_id IS NOT NULL AND lat BETWEEN 29.5 AND 30.1 AND lon BETWEEN -95.8 AND -95.1
              GROUP BY event_id HAVING count(*) > 1)""",
    "null_scores": """
        SELECT route_id AS id, segment_date AS period, efficiency_score AS score FROM efficiency
        UNION ALL SELECT vehicle_id, "month", safety_score FROM performance""",
    "distinct_vehicles_by_zone_month": """
        SELECT r.zone, CAST(date_trunc('month', g.event_date) AS DATE) AS "month", count(DISTINCT g.vehicle_id) AS vehicles
        FROM stg_gps g LEFT JOIN raw_routes r ON g.route_id = r.route_id GROUP BY ALL""",
    "question_speed_by_zone": f"""
        SELECT zone, {_mean('avg_speed')} AS avg_speed_mph FROM efficiency GROUP BY zone""",
    "dash_absent_columns": """
        SELECT vehicle_id, model, vehicle_class, last_service_date, days_since_service, total_cost_ytd, maintenance_urgency
        FROM health""",
    "metric_groupings": f"""
        SELECT 0 AS query, zone, NULL::varchar AS district, {_mean('avg_speed')} AS avg_speed,
          CAST(sum(CAST(total_miles AS DECIMAL(18,4))) AS DOUBLE) AS total_miles, NULL::double AS efficiency_score, NULL::bigint AS vehicles_on_route
        FROM efficiency GROUP BY zone
        UNION ALL SELECT 1, NULL, district, NULL, NULL, {_mean('efficiency_score')}, NULL FROM efficiency GROUP BY district
        UNION ALL SELECT 2, zone, district, {_mean('avg_speed')}, NULL, NULL, CAST(sum(vehicles_on_route) AS BIGINT)
        FROM efficiency GROUP BY zone, district
        UNION ALL SELECT 3, NULL, NULL, NULL, CAST(sum(CAST(total_miles AS DECIMAL(18,4))) AS DOUBLE), {_mean('efficiency_score')}, NULL
        FROM efficiency""",
    "ingest_csv_multiline": """
        SELECT * REPLACE (CASE (CAST(substr(log_id, 4) AS BIGINT) - 1) % 5 WHEN 0 THEN 'plain' WHEN 1 THEN 'first' || chr(10) || 'second "line", end'
          WHEN 2 THEN chr(10) || ',' || chr(10) WHEN 3 THEN 'a, "b"' ELSE 'say "hi' END AS notes)
        FROM raw_maintenance_logs""",
    "raw_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}"
        for t in ("routes", "vehicles", "stops", "gps_events", "maintenance_logs")),
    "ingest_csv_clean": """
        SELECT event_id, vehicle_id, route_id, lat, lon,
          CASE WHEN speed_mph NOT IN ('', 'NULL', 'null') THEN CAST(speed_mph AS DOUBLE) END AS speed_mph,
          CAST(heading_deg AS INTEGER) AS heading_deg, event_ts, event_date
        FROM parsed WHERE reason IS NULL""",
    "ingest_csv_rejects": """
        SELECT nullif(event_id, '') AS event_id, nullif(speed_mph, '') AS speed_mph, heading_deg,
          CAST(event_ts AS VARCHAR) AS event_ts, reason
        FROM parsed WHERE reason IS NOT NULL""",
    "ingest_load_summary": """
        SELECT 'gps_events' AS table_name,
          count(*) FILTER (WHERE reason IS NULL) AS rows_loaded,
          count(*) FILTER (WHERE reason IS NOT NULL) AS rows_errored,
          CASE WHEN count(reason) = 0 THEN 'success' ELSE 'partial' END AS status
        FROM parsed""",
}


def _spoilt(table: str, key: str, rules: dict[str, list[tuple[int, str]]]) -> str:
    """A raw table with values replaced where the number of its id is a multiple; the first rule counts."""
    changed = []
    for column, cases in rules.items():
        whens = " ".join(f"WHEN CAST(substr({key}, 4) AS BIGINT) % {every} = 0 THEN {bad}" for every, bad in cases)
        changed.append(f'CASE {whens} ELSE "{column}" END AS "{column}"')
    return f"raw_{table} AS (SELECT * REPLACE ({', '.join(changed)}) FROM clean_{table})"


_DIRTY = [
    _spoilt("routes", "route_id", {"route_id": [(12, "'RT-0001'")], "zone": [(7, "NULL")], "total_stops": [(5, "0")]}),
    _spoilt("vehicles", "vehicle_id", {"vehicle_id": [(97, "'VH-000001'")], "vehicle_class": [(11, "'tank'")],
                                       "status": [(13, "NULL")], "year": [(17, "2009")]}),
    _spoilt("gps_events", "event_id", {"event_id": [(101, "NULL"), (103, "'EV-0000001'")], "vehicle_id": [(89, "NULL")],
                                       "route_id": [(83, "NULL")], "speed_mph": [(79, "NULL"), (73, "150.0e0")]}),
    _spoilt("maintenance_logs", "log_id", {"log_id": [(29, "NULL")], "vehicle_id": [(31, "NULL")],
                                           "cost_usd": [(19, "-cost_usd"), (23, "NULL")]}),
]


# The spoilt pings with batch 1 of three as it landed anew.
_RELOADED = """,
reloaded AS (
  SELECT event_id, lat, lon FROM raw_gps_events WHERE extract(second FROM event_ts) % 3 <> 1
  UNION ALL
  SELECT CASE WHEN extract(minute FROM event_ts) % 7 = 0 THEN 'EV-0000002' ELSE event_id END, lat, lon
  FROM raw_gps_events WHERE extract(second FROM event_ts) % 3 = 1 AND extract(minute FROM event_ts) % 5 <> 0)"""

_SPEEDLESS = """raw_gps_events AS (
  SELECT * REPLACE (CASE WHEN route_id NOT IN ('RT-0003') AND vehicle_id NOT IN ('VH-000004', 'VH-000009') THEN speed_mph END AS speed_mph)
  FROM clean_gps_events)"""


def _replaced(tables: tuple[str, ...], instead: list[str]) -> str:
    """The same chain over other raw tables: the clean ones step back under another name."""
    clean, rest = CTES.split("stg_gps AS (", 1)
    for table in tables:
        clean = clean.replace(f"raw_{table} AS (", f"clean_{table} AS (")
    return clean + ",\n".join(instead) + ",\nstg_gps AS (" + rest


def _ctes(name: str) -> str:
    if name.startswith("dq_"):
        return _replaced(("routes", "vehicles", "gps_events", "maintenance_logs"), _DIRTY) + _RELOADED
    return _replaced(("gps_events",), [_SPEEDLESS]) if name == "null_scores" else CTES


def statements() -> dict[str, str]:
    return {name: f"WITH {_ctes(name)}\n{select}" for name, select in SELECTS.items()}

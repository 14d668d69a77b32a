"""Oracle SQL (DuckDB) for every registered query with a relational twin."""

from __future__ import annotations

from citystream.plans.oracle import with_streams

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def R(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: round the shortest decimal text of the
    value half away from zero (DuckDB's own ``round`` uses the binary value)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"

ORACLE: dict[str, str] = {}

ORACLE["ward_energy_15m"] = with_streams(f"""
SELECT ward_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
       {R("total_kwh_consumed", 4)} AS total_kwh_consumed,
       {R("avg_power_factor", 4)} AS avg_power_factor,
       {R("peak_voltage", 4)} AS peak_voltage,
       CAST(CAST(window_start AS DATE) AS VARCHAR) AS date
FROM (SELECT ward_id, time_bucket(INTERVAL 15 MINUTE, event_time, {EPOCH}) AS window_start,
             sum(kwh_reading) AS total_kwh_consumed, avg(power_factor) AS avg_power_factor,
             max(voltage) AS peak_voltage
      FROM smart_meters WHERE event_time IS NOT NULL
      GROUP BY ALL)
""", "smart_meters")

ORACLE["ward_energy_history"] = ORACLE["ward_energy_15m"]

_ROLLING = f"""rolling AS (
  SELECT zone, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
         avg(aqi_i) AS rolling_avg_aqi, count(*) AS readings
  FROM (SELECT zone, CAST(aqi AS BIGINT) AS aqi_i,
               time_bucket(INTERVAL 1 MINUTE, event_time, {EPOCH}) - INTERVAL 1 MINUTE * k AS window_start
        FROM air_quality, range(10) t(k)
        WHERE aqi IS NOT NULL AND aqi = floor(aqi) AND event_time IS NOT NULL)
  GROUP BY zone, window_start)"""

ORACLE["aqi_rolling_10m"] = with_streams(f"""
SELECT zone, window_start, window_end, {R("rolling_avg_aqi", 4)} AS rolling_avg_aqi, readings
FROM rolling
""", "air_quality", extra=(_ROLLING,))

ORACLE["health_advisories"] = with_streams(f"""
SELECT r.zone, z.zone_name, z.population, z.num_schools, r.window_start, r.window_end,
       {R("r.rolling_avg_aqi", 1)} AS rolling_avg_aqi, r.readings, 'UNHEALTHY' AS advisory_level
FROM rolling r JOIN zone_profile z ON r.zone = z.zone
WHERE r.rolling_avg_aqi > 150
""", "air_quality", "zone_profile", extra=(_ROLLING,))

_DLQ = """dlq AS (
  SELECT CASE WHEN aqi IS NULL THEN 'NULL_AQI'
              WHEN NOT (aqi BETWEEN 0 AND 500) THEN 'AQI_OUT_OF_RANGE' END AS error_reason,
         'air_quality' AS source_topic, "partition" AS source_partition, "offset" AS source_offset,
         event_time AS quarantined_at,
         CAST(json_object('sensor_id', sensor_id, 'zone', zone, 'pm25', pm25, 'pm10', pm10, 'no2', no2, 'aqi', aqi,
                          'timestamp', "timestamp") AS VARCHAR) AS original
  FROM air_quality
  UNION ALL
  SELECT CASE WHEN lat IS NULL OR lon IS NULL THEN 'NULL_GPS'
              WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN 'IMPOSSIBLE_GPS' END,
         'bus_gps', "partition", "offset", event_time,
         CAST(json_object('bus_id', bus_id, 'route_id', route_id, 'lat', lat, 'lon', lon, 'speed_kmh', speed_kmh,
                          'occupancy_pct', occupancy_pct, 'timestamp', "timestamp") AS VARCHAR)
  FROM bus_gps)"""

ORACLE["dlq_records"] = with_streams("""
SELECT error_reason, source_topic, source_partition, source_offset, quarantined_at, original
FROM dlq WHERE error_reason IS NOT NULL
""", "air_quality", "bus_gps", extra=(_DLQ,))

ORACLE["dlq_error_distribution"] = with_streams(f"""
SELECT error_reason, count(*) AS n,
       {R("count(*) * 100.0 / sum(count(*)) OVER ()", 4)} AS pct
FROM dlq WHERE error_reason IS NOT NULL GROUP BY error_reason
""", "air_quality", "bus_gps", extra=(_DLQ,))

ORACLE["dlq_by_topic"] = with_streams("""
SELECT source_topic, count(*) AS n FROM dlq WHERE error_reason IS NOT NULL GROUP BY source_topic
""", "air_quality", "bus_gps", extra=(_DLQ,))

ORACLE["dlq_totals"] = with_streams("""
SELECT count(*) FILTER (WHERE error_reason IS NULL) AS good,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS bad
FROM dlq
""", "air_quality", "bus_gps", extra=(_DLQ,))

ORACLE["dlq_report_text"] = with_streams("""
, every AS (SELECT * FROM dlq WHERE error_reason IS NOT NULL),
bad AS (SELECT * FROM every WHERE quarantined_at >= (SELECT max(quarantined_at) FROM every) - INTERVAL 300 SECOND),
tot AS (SELECT count(*) AS total FROM bad),
reasons AS (SELECT error_reason AS label, count(*) AS n FROM bad GROUP BY 1),
topics AS (SELECT source_topic AS label, count(*) AS n FROM bad GROUP BY 1),
lines AS (
  SELECT 0 AS sect, 1 AS r, repeat('=', 50) AS line
  UNION ALL SELECT 0, 2, 'City stream DLQ Report'
  UNION ALL SELECT 0, 3, 'Window    : 300 seconds'
  UNION ALL SELECT 0, 4, 'Total bad records: ' || CAST(total AS VARCHAR) FROM tot
  UNION ALL SELECT 0, 5, repeat('-', 50)
  UNION ALL SELECT 0, 6, 'Error type distribution:'
  UNION ALL SELECT 100, row_number() OVER (ORDER BY n DESC, label),
         printf('   %-18s %6d  (%5.1f%%)', label, n, n * 100.0 / (SELECT total FROM tot)) FROM reasons
  UNION ALL SELECT 200, 1, repeat('-', 50)
  UNION ALL SELECT 200, 2, 'By source topic:'
  UNION ALL SELECT 300, row_number() OVER (ORDER BY n DESC, label), printf('   %-28s %6d', label, n) FROM topics
  UNION ALL SELECT 400, 1, repeat('=', 50))
SELECT row_number() OVER (ORDER BY sect, r) AS line_no, line FROM lines
""", "air_quality", "bus_gps", extra=(_DLQ,))

ORACLE["aqi_data_quality"] = with_streams("""
SELECT zone, count(*) AS produced, count(*) FILTER (WHERE aqi IS NULL) AS null_aqi
FROM air_quality GROUP BY zone
""", "air_quality")

ORACLE["aqi_emergency"] = with_streams("""
SELECT 'AQI_EMERGENCY' AS incident_type, sensor_id, zone, aqi,
       "timestamp" AS detected_from_timestamp, event_time, event_id
FROM air_quality WHERE aqi IS NOT NULL AND aqi > 300
""", "air_quality")

ORACLE["bus_gps_enriched"] = with_streams("""
, routes AS (SELECT route_id, max_by(route_name, seq) AS route_name,
                    max_by(scheduled_arrival_time, seq) AS scheduled_arrival_time,
                    max_by(terminal, seq) AS terminal
             FROM route_schedule GROUP BY route_id)
SELECT g.bus_id, g.route_id, g.lat, g.lon, g.speed_kmh, g.occupancy_pct, g."timestamp", g.event_id,
       coalesce(r.route_name, 'UNKNOWN') AS route_name, r.scheduled_arrival_time,
       coalesce(r.terminal, 'UNKNOWN') AS terminal
FROM bus_gps g LEFT JOIN routes r ON g.route_id = r.route_id
""", "bus_gps", "route_schedule")

ORACLE["traffic_gridlock"] = with_streams("""
, t AS (SELECT *, coalesce(junction_id, 'UNKNOWN') AS k,
               coalesce(avg_wait_sec, 0.0) > 180 AS over_ FROM traffic_signals),
isl AS (SELECT *, sum(CASE WHEN over_ THEN 0 ELSE 1 END) OVER (
          PARTITION BY k ORDER BY event_time NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS island
        FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY k, island ORDER BY event_time NULLS FIRST, event_id) AS rn
      FROM isl WHERE over_)
SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, junction_id, zone, coalesce(avg_wait_sec, 0.0) AS avg_wait_sec,
       3 AS consecutive_cycles, "timestamp" AS detected_from_timestamp, event_time, event_id
FROM r WHERE rn % 3 = 0
""", "traffic_signals")


def _round_ratio_sql(num: str, den: int) -> str:
    """Binary-exact round(num / den, 1) for integers (twin of functions.numeric)."""
    step = den // 10
    q, rem, d = f"({num} // {step})", f"({num} % {step})", f"({num} / {den}.0)"
    two_k = f"pow(2.0, 53 - CAST(floor(log2({d})) AS INTEGER))"
    lhs, rhs = f"CAST({d} * {two_k} AS BIGINT) * 20", f"({q} * 2 + 1) * CAST({two_k} AS BIGINT)"
    return (f"(({q} + CASE WHEN {rem} * 2 > {step} THEN 1 WHEN {rem} * 2 < {step} THEN 0 "
            f"WHEN {lhs} < {rhs} THEN 0 WHEN {lhs} > {rhs} THEN 1 ELSE {q} % 2 END) / 10.0)")


def _bunching_sql(duration_ms: int) -> str:
    """Sequential model: every event vs the latest position of every other bus
    on the route; islands of close observations; recursive greedy restart."""
    hav = ("2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(y.lat - e.lat) / 2) * sin(radians(y.lat - e.lat) / 2)"
           " + cos(radians(e.lat)) * cos(radians(y.lat))"
           " * (sin(radians(y.lon - e.lon) / 2) * sin(radians(y.lon - e.lon) / 2)))))")
    return with_streams(f"""
, g AS (SELECT coalesce(route_id, 'UNKNOWN') AS rk, route_id, bus_id, lat, lon, "timestamp", event_time,
               event_id, coalesce(CAST(trunc(epoch_us(event_time) / 1e6 * 1000.0) AS BIGINT), 0) AS ts_ms,
               coalesce(epoch_us(event_time), -9223372036854775807) AS ok
        FROM bus_gps WHERE bus_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL),
obs AS (
  SELECT e.rk, e.route_id, least(e.bus_id, y.bus_id) AS a, greatest(e.bus_id, y.bus_id) AS b,
         e.event_time, e.event_id, e.ok, e.ts_ms, e."timestamp", {hav} AS dist
  FROM g e JOIN g y ON e.rk = y.rk AND e.bus_id <> y.bus_id
       AND (y.ok < e.ok OR (y.ok = e.ok AND y.event_id < e.event_id))
  QUALIFY row_number() OVER (PARTITION BY e.rk, e.event_id, y.bus_id ORDER BY y.ok DESC, y.event_id DESC) = 1),
isl AS (SELECT *, sum(CASE WHEN dist <= 200 THEN 0 ELSE 1 END) OVER (
          PARTITION BY rk, a, b ORDER BY ok, event_id ROWS UNBOUNDED PRECEDING) AS island
        FROM obs),
cl AS (SELECT *, row_number() OVER (PARTITION BY rk, a, b, island ORDER BY ok, event_id) AS rn
       FROM isl WHERE dist <= 200),
rec AS (
  SELECT rk, a, b, island, rn, ts_ms AS first_ms, false AS hit, CAST(0 AS BIGINT) AS elapsed
  FROM cl WHERE rn = 1
  UNION ALL
  SELECT c.rk, c.a, c.b, c.island, c.rn,
         CASE WHEN c.ts_ms - r.first_ms > {duration_ms} THEN c.ts_ms ELSE r.first_ms END,
         c.ts_ms - r.first_ms > {duration_ms}, c.ts_ms - r.first_ms
  FROM rec r JOIN cl c ON c.rk = r.rk AND c.a = r.a AND c.b = r.b AND c.island = r.island
                       AND c.rn = r.rn + 1)
SELECT 'BUS_BUNCHING' AS incident_type, c.route_id, c.a AS bus_a, c.b AS bus_b,
       {R("c.dist", 1)} AS distance_m, {_round_ratio_sql("r.elapsed", 60000)} AS minutes_close,
       c."timestamp" AS detected_from_timestamp, c.event_time, c.event_id
FROM rec r JOIN cl c ON c.rk = r.rk AND c.a = r.a AND c.b = r.b AND c.island = r.island AND c.rn = r.rn
WHERE r.hit
""", "bus_gps", recursive=True)


ORACLE["bus_bunching"] = _bunching_sql(300_000)
ORACLE["bus_bunching_day"] = _bunching_sql(86_400_000)

ORACLE["incident_feed"] = (
    "SELECT * REPLACE (CAST(consecutive_cycles AS DOUBLE) AS consecutive_cycles) FROM ("
    f"SELECT * FROM ({ORACLE['aqi_emergency']}) UNION ALL BY NAME "
    f"SELECT * FROM ({ORACLE['traffic_gridlock']}) UNION ALL BY NAME "
    f"SELECT * FROM ({ORACLE['bus_bunching']}))")

ORACLE["latest_incidents"] = f"""
SELECT * FROM ({ORACLE['incident_feed']})
ORDER BY event_time DESC NULLS LAST, event_id DESC, incident_type, coalesce(bus_a, ''), coalesce(bus_b, '')
LIMIT 100"""

ORACLE["latest_advisories"] = f"""
SELECT * FROM ({ORACLE['health_advisories']}) ORDER BY window_start DESC, zone LIMIT 100"""

ORACLE["latest_ward_energy_chart"] = f"""
SELECT total_kwh_consumed, avg_power_factor, peak_voltage
FROM ({ORACLE['ward_energy_15m']}) ORDER BY window_start DESC, ward_id LIMIT 100"""

ORACLE["topic_view"] = with_streams("""
, env AS (SELECT topic, "partition", "offset",
                 CASE WHEN event_id % 41 = 0 THEN 'garbage text'
                      ELSE '{"zone": ' || coalesce('"' || zone || '"', 'null')
                           || ', "junction_id": ' || coalesce('"' || junction_id || '"', 'null')
                           || ', "vehicle_count": ' || coalesce(CAST(vehicle_count AS VARCHAR), 'null')
                           || ', "avg_wait_sec": ' || coalesce(CAST(avg_wait_sec AS VARCHAR), 'null')
                           || ', "signal_phase": ' || coalesce('"' || signal_phase || '"', 'null')
                           || ', "timestamp": ' || coalesce('"' || "timestamp" || '"', 'null') || '}' END AS v
          FROM traffic_signals)
SELECT topic, "partition", "offset",
       '[p' || CAST("partition" AS VARCHAR) || '@' || CAST("offset" AS VARCHAR) || '] '
       || v AS line
FROM env
""", "traffic_signals")

ORACLE["signal_adaptations"] = with_streams("""
SELECT junction_id, coalesce(avg_wait_sec, 0.0) AS avg_wait_sec, "partition", "offset"
FROM traffic_signals WHERE coalesce(avg_wait_sec, 0.0) > 180
""", "traffic_signals")

ORACLE["signal_partition_throughput"] = with_streams("""
SELECT topic, "partition", count(*) AS messages FROM traffic_signals GROUP BY ALL
""", "traffic_signals")

ORACLE["consumer_lag"] = with_streams("""
, ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM traffic_signals GROUP BY ALL),
committed AS (
  SELECT 'HIGH_PRIORITY' AS group_id, topic, "partition", end_offset - "partition" AS committed_offset FROM ends
  UNION ALL SELECT 'STANDARD_PRIORITY', topic, "partition", end_offset // 2 FROM ends WHERE "partition" = 0
  UNION ALL SELECT 'STANDARD_PRIORITY', topic, "partition", end_offset + 5 FROM ends WHERE "partition" = 1
  UNION ALL SELECT 'STANDARD_PRIORITY', topic, "partition" + 1, 10 FROM ends WHERE "partition" = 2),
per AS (SELECT c.group_id, greatest(0, coalesce(e.end_offset, 0) - c.committed_offset) AS lag
        FROM committed c LEFT JOIN ends e ON c.topic = e.topic AND c."partition" = e."partition"),
groups AS (SELECT * FROM (VALUES ('HIGH_PRIORITY'), ('STANDARD_PRIORITY'), ('IDLE')) t(group_id))
SELECT g.group_id, CAST(l.lag AS DOUBLE) AS lag
FROM groups g LEFT JOIN (SELECT group_id, CAST(sum(lag) AS BIGINT) AS lag FROM per GROUP BY group_id) l
  ON g.group_id = l.group_id
""", "traffic_signals")

ORACLE["zone_status"] = with_streams(f"""
, last AS (SELECT * FROM rolling QUALIFY row_number() OVER (PARTITION BY zone ORDER BY window_start DESC) = 1)
SELECT zone, window_start, {R("rolling_avg_aqi", 1)} AS rolling_avg_aqi,
       CASE WHEN rolling_avg_aqi > 300 THEN 'Hazardous' WHEN rolling_avg_aqi > 150 THEN 'Unhealthy'
            ELSE 'Acceptable' END AS status,
       'AQI: ' || CASE WHEN rolling_avg_aqi > 300 THEN 'Hazardous' WHEN rolling_avg_aqi > 150 THEN 'Unhealthy'
                       ELSE 'Acceptable' END || ' in Zone ' || zone AS message
FROM last
""", "air_quality", extra=(_ROLLING,))


def D(expr: str) -> str:
    """Double -> exact DECIMAL through its shortest text (Spark's cast)."""
    return f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18))"


def _rollup_sql(unit: str) -> str:
    return with_streams(f"""
, w AS (SELECT ward_id, time_bucket(INTERVAL 15 MINUTE, event_time, {EPOCH}) AS window_start,
               sum(kwh_reading) AS total_kwh_consumed, avg(power_factor) AS avg_power_factor,
               max(voltage) AS peak_voltage
        FROM smart_meters WHERE event_time IS NOT NULL GROUP BY ALL)
SELECT ward_id, date_trunc('{unit}', window_start) AS period_start,
       CAST(round(sum({D("total_kwh_consumed")}), 4) AS DOUBLE) AS total_kwh_consumed,
       {R(f'sum({D("avg_power_factor")}) / count(*)', 4)} AS avg_power_factor,
       {R("max(peak_voltage)", 4)} AS peak_voltage, count(*) AS windows
FROM w GROUP BY ALL
""", "smart_meters")


ORACLE["ward_energy_weekly"] = _rollup_sql("week")
ORACLE["ward_energy_monthly"] = _rollup_sql("month")

ORACLE["buses_within_200m"] = with_streams(f"""
, pos AS (SELECT bus_id, lat, lon FROM bus_gps
          WHERE bus_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY event_time DESC, event_id DESC) = 1),
pairs AS (
  SELECT a.bus_id AS bus_a, b.bus_id AS bus_b,
         2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2)
           + cos(radians(a.lat)) * cos(radians(b.lat))
           * (sin(radians(b.lon - a.lon) / 2) * sin(radians(b.lon - a.lon) / 2))))) AS d
  FROM pos a JOIN pos b ON a.bus_id < b.bus_id)
SELECT bus_a, bus_b, {R("d", 4)} AS distance_m FROM pairs WHERE d <= 200
""", "bus_gps")

ORACLE["redelivered_dedup"] = with_streams("""
, d AS (SELECT sensor_id, "timestamp", aqi, "partition", "offset" FROM air_quality
        UNION ALL
        SELECT sensor_id, "timestamp", aqi, "partition", "offset" + 1000000 FROM air_quality
        WHERE event_id % 7 = 0)
SELECT sensor_id, "timestamp", aqi, "partition", "offset" FROM d
QUALIFY row_number() OVER (PARTITION BY sensor_id, "timestamp" ORDER BY "offset") = 1
""", "air_quality")

ORACLE["health_advisories_sql"] = ORACLE["health_advisories"]

_PLACES = """
, pos AS (SELECT bus_id, lat, lon FROM bus_gps
          WHERE bus_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY bus_id ORDER BY event_time DESC, event_id DESC) = 1),
placed AS (SELECT *, min(bus_id) OVER (PARTITION BY lat, lon) AS place_id, count(*) OVER (PARTITION BY lat, lon) AS n FROM pos),
near AS (
  SELECT a.bus_id AS a, b.bus_id AS b, a.place_id AS place_a, b.place_id AS place_b, a.n AS n_a, b.n AS n_b,
         2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2)
           + cos(radians(a.lat)) * cos(radians(b.lat))
           * (sin(radians(b.lon - a.lon) / 2) * sin(radians(b.lon - a.lon) / 2))))) AS d
  FROM placed a JOIN placed b ON a.bus_id <> b.bus_id)"""

ORACLE["bus_places_200m"] = with_streams(_PLACES + """
SELECT p.bus_id, p.place_id, count(near.b) AS n_within
FROM placed p LEFT JOIN near ON near.a = p.bus_id AND near.d <= 200 GROUP BY p.bus_id, p.place_id
""", "bus_gps")

ORACLE["places_within_200m"] = with_streams(_PLACES + f"""
SELECT place_a, place_b, {R("d", 4)} AS distance_m, n_a, n_b
FROM near WHERE d <= 200 AND a = place_a AND b = place_b AND place_a < place_b
""", "bus_gps")

_RETAINED = {"bus_gps": 1, "traffic_signals": 7, "air_quality": 90, "smart_meters": 365, "bus_gps_enriched": 1,
             "incidents": 30, "ward_energy_summary": 90, "health_advisories": 90, "dlq": 14}
_DATED = "\nUNION ALL\n".join(
    [f"SELECT '{name}' AS dataset, event_time FROM ({with_streams(f'SELECT event_time FROM {name}', name)})"
     for name in ("bus_gps", "traffic_signals", "air_quality", "smart_meters")]
    + [f"SELECT 'bus_gps_enriched', event_time FROM ({with_streams('SELECT event_time FROM bus_gps', 'bus_gps')})"]
    + [f"SELECT '{name}', {at} FROM ({ORACLE[query]})" for name, query, at in (
        ("incidents", "incident_feed", "event_time"), ("ward_energy_summary", "ward_energy_15m", "window_end"),
        ("health_advisories", "health_advisories", "window_end"), ("dlq", "dlq_records", "quarantined_at"))])

ORACLE["retention_summary"] = f"""
WITH allr AS ({_DATED}),
days AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {d})" for n, d in _RETAINED.items())}) v(dataset, retention_days)),
j AS (SELECT allr.dataset, event_time, as_of, retention_days
      FROM allr JOIN (SELECT dataset, max(event_time) AS as_of FROM allr GROUP BY dataset) m USING (dataset) JOIN days USING (dataset))
SELECT dataset, retention_days, count(*) AS total,
       count(*) FILTER (WHERE event_time >= as_of - to_days(CAST(retention_days AS INTEGER))) AS retained
FROM j GROUP BY dataset, retention_days
"""

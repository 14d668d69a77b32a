"""DuckDB twins of the TESTDATA adapters, prepended as CTEs to oracle SQL.

Each CTE mirrors ``citystream.sources.testdata`` expression for expression
(``div`` -> ``//``, ``get_json_object`` -> ``->>``, DOUBLE-typed literals).
"""

from __future__ import annotations

_K = "CAST(props->>'k' AS INTEGER)"
_ZONE = "'Z' || CAST(1 + user_id % 6 AS VARCHAR)"


def _common(stream: str, n: int) -> str:
    return (f"strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS \"timestamp\", ts AS event_time, event_id, "
            f"'{stream}' AS topic, CAST(event_id % {n} AS INTEGER) AS \"partition\", "
            f"event_id // {n} AS \"offset\"")


CTES = {
    "air_quality": f"""air_quality AS (
  SELECT 'AQ-' || CAST(user_id AS VARCHAR) AS sensor_id, {_ZONE} AS zone,
         value / 2.0::DOUBLE AS pm25, value AS pm10, CAST({_K} AS DOUBLE) AS no2,
         CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(floor(value * 2.0::DOUBLE) AS DOUBLE) END AS aqi,
         {_common('air_quality', 2)}
  FROM events)""",
    "bus_gps": f"""bus_gps AS (
  SELECT 'B' || CAST(user_id AS VARCHAR) AS bus_id,
         'R' || CAST(101 + user_id // 3 AS VARCHAR) AS route_id,
         CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 102.97::DOUBLE
              ELSE 12.9716::DOUBLE + ({_K} % 10) * 0.0004::DOUBLE END AS lat,
         77.5946::DOUBLE AS lon, CAST({_K} % 56 AS DOUBLE) AS speed_kmh,
         10 + {_K} % 91 AS occupancy_pct,
         {_common('bus_gps', 6)}
  FROM events)""",
    "traffic_signals": f"""traffic_signals AS (
  SELECT 'J' || CAST(user_id % 12 AS VARCHAR) AS junction_id, {_ZONE} AS zone,
         {_K} AS vehicle_count,
         CASE WHEN event_id % 33 = 0 THEN NULL ELSE value * 4.0::DOUBLE END AS avg_wait_sec,
         CASE {_K} % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'GREEN' ELSE 'AMBER' END AS signal_phase,
         {_common('traffic_signals', 3)}
  FROM events)""",
    "smart_meters": f"""smart_meters AS (
  SELECT 'M' || CAST(user_id AS VARCHAR) AS meter_id,
         'W' || CAST(1 + user_id % 8 AS VARCHAR) AS ward_id,
         value AS kwh_reading, 218.0::DOUBLE + {_K} * 0.27::DOUBLE AS voltage,
         0.8::DOUBLE + ({_K} % 20) * 0.01::DOUBLE AS power_factor,
         {_common('smart_meters', 4)}
  FROM events)""",
    "route_schedule": """route_schedule AS (
  SELECT 'R' || CAST(101 + n_nationkey AS VARCHAR) AS route_id, n_name AS route_name,
         '08:' || lpad(CAST(n_nationkey + 5 AS VARCHAR), 2, '0') AS scheduled_arrival_time,
         r_name AS terminal, CAST(n_nationkey AS BIGINT) AS seq
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "zone_profile": """zone_profile AS (
  SELECT 'Z' || CAST(1 + r_regionkey AS VARCHAR) AS zone, r_name AS zone_name,
         CAST(100000 + 10000 * r_regionkey AS INTEGER) AS population,
         CAST(20 + r_regionkey AS INTEGER) AS num_schools
  FROM region)""",
}


def with_streams(body: str, *names: str, extra: tuple[str, ...] = (), recursive: bool = False) -> str:
    """``WITH [RECURSIVE] <adapter CTEs>, <extra CTEs> <body>``."""
    parts = [CTES[n] for n in names] + list(extra)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body

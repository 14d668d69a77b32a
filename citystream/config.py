"""Rule constants and fixed domain values.

Every threshold is a parameter of the operator that uses it; the defaults
below are the values the original city application ships with.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the original application's behaviour)
# ---------------------------------------------------------------------------
AQI_HAZARDOUS = 300          # AQI emergency: aqi strictly greater than this
AQI_UNHEALTHY = 150          # health advisory: rolling average strictly greater
AQI_MIN, AQI_MAX = 0, 500    # validation range, inclusive
GRIDLOCK_WAIT_SEC = 180      # gridlock: avg wait strictly greater than this
GRIDLOCK_CYCLES = 3          # ... for this many consecutive cycles
BUNCHING_DISTANCE_M = 200    # bunching: distance <= this (inclusive)
BUNCHING_DURATION_SEC = 300  # ... for strictly longer than this
EARTH_RADIUS_M = 6_371_000
WARD_WINDOW = "15 minutes"
ADVISORY_WINDOW, ADVISORY_SLIDE = "10 minutes", "1 minute"
WATERMARK_DELAY = "5 minutes"
DLQ_REPORT_WINDOW_SEC = 300

# Reason codes of the dead-letter queue.
NULL_AQI = "NULL_AQI"
AQI_OUT_OF_RANGE = "AQI_OUT_OF_RANGE"
NULL_GPS = "NULL_GPS"
IMPOSSIBLE_GPS = "IMPOSSIBLE_GPS"
MALFORMED_JSON = "MALFORMED_JSON"  # extension: unparsable records are routed too

# Incident types.
AQI_EMERGENCY = "AQI_EMERGENCY"
TRAFFIC_GRIDLOCK = "TRAFFIC_GRIDLOCK"
BUS_BUNCHING = "BUS_BUNCHING"
ADVISORY_LEVEL = "UNHEALTHY"

# Stream names and their partition counts; retention in days per dataset.
STREAM_PARTITIONS = {
    "bus_gps": 6,
    "traffic_signals": 3,
    "air_quality": 2,
    "smart_meters": 4,
}
RETENTION_DAYS = {
    "bus_gps": 1,
    "traffic_signals": 7,
    "air_quality": 90,
    "smart_meters": 365,
    "bus_gps_enriched": 1,
    "incidents": 30,
    "ward_energy_summary": 90,
    "health_advisories": 90,
    "dlq": 14,
}
CONSUMER_GROUPS = ("HIGH_PRIORITY", "STANDARD_PRIORITY")
SERVING_LATEST_N = 100

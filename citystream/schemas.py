"""Explicit schemas of the city streams, lookups and outputs (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType, BinaryType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, I, L, T = StringType(), DoubleType(), IntegerType(), LongType(), TimestampType()

BUS_GPS = _s(("bus_id", S), ("route_id", S), ("lat", D), ("lon", D), ("speed_kmh", D),
             ("occupancy_pct", I), ("timestamp", S))
TRAFFIC_SIGNALS = _s(("junction_id", S), ("zone", S), ("vehicle_count", I),
                     ("avg_wait_sec", D), ("signal_phase", S), ("timestamp", S))
# aqi is parsed as DOUBLE: an INT schema would silently null 150.5 or "150".
AIR_QUALITY = _s(("sensor_id", S), ("zone", S), ("pm25", D), ("pm10", D), ("no2", D),
                 ("aqi", D), ("timestamp", S))
SMART_METERS = _s(("meter_id", S), ("ward_id", S), ("kwh_reading", D), ("voltage", D),
                  ("power_factor", D), ("timestamp", S))

STREAM_SCHEMAS = {
    "bus_gps": BUS_GPS,
    "traffic_signals": TRAFFIC_SIGNALS,
    "air_quality": AIR_QUALITY,
    "smart_meters": SMART_METERS,
}
STREAM_KEYS = {
    "bus_gps": "route_id",
    "traffic_signals": "junction_id",
    "air_quality": "sensor_id",
    "smart_meters": "ward_id",
}

ROUTE_SCHEDULE = _s(("route_id", S), ("route_name", S), ("scheduled_arrival_time", S),
                    ("terminal", S))
ZONE_PROFILE = _s(("zone", S), ("zone_name", S), ("population", I), ("num_schools", I))

# Kafka-shaped record envelope.
ENVELOPE = _s(("key", BinaryType()), ("value", BinaryType()), ("topic", S),
              ("partition", I), ("offset", L), ("timestamp", T))

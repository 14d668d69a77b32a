"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from citystream.functions.geo import haversine_m
from citystream.functions.timefn import epoch_millis, iso_utc, parse_event_time, to_ntz
from citystream.functions.jsonfn import decode_json, payload_json, pretty_or_raw
from citystream.functions.textfmt import fixed_width_line

__all__ = [
    "haversine_m", "epoch_millis", "iso_utc", "parse_event_time", "to_ntz",
    "decode_json", "payload_json", "pretty_or_raw", "fixed_width_line",
]

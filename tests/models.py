"""Plain-Python models of the sequence rules, written from the rules' text.

Gridlock: cut a junction's cycles into stretches of congested ones; every
n-th cycle of a stretch alerts. Bunching: look at one pair of buses at a time;
cut its observations into stretches of close ones; a stretch's timer starts
with its first observation and restarts at each alert.
"""

from __future__ import annotations

import math
from itertools import combinations, groupby


def _unit(lat, lon):
    lat, lon = math.radians(lat), math.radians(lon)
    return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)


def haversine_m(lat1, lon1, lat2, lon2, r=6_371_000):
    """Great-circle distance from the chord between two points of the unit sphere."""
    return r * 2 * math.asin(min(1.0, math.dist(_unit(lat1, lon1), _unit(lat2, lon2)) / 2))


def gridlock(rows, wait_sec=180, cycles=3):
    """rows: dicts with junction_id, avg_wait_sec, event_id, in event order."""
    def junction(row):
        return row.get("junction_id") or "UNKNOWN"

    alerts = set()
    for _, own in groupby(sorted(rows, key=junction), junction):  # stable: keeps the order of events
        for congested, stretch in groupby(own, lambda r: (r.get("avg_wait_sec") or 0) > wait_sec):
            if congested:
                alerts.update(r["event_id"] for r in list(stretch)[cycles - 1::cycles])
    return [r["event_id"] for r in rows if r["event_id"] in alerts]


def bunching(rows, distance_m=200, duration_ms=300_000):
    """rows: dicts with route_id, bus_id, lat, lon, ts_ms, event_id, in order.
    Returns (event_id, bus_a, bus_b, dist, elapsed_ms) per alert."""
    routes = {}
    for n, row in enumerate(rows):
        if None not in (row.get("bus_id"), row.get("lat"), row.get("lon")):
            routes.setdefault(row.get("route_id") or "UNKNOWN", {}).setdefault(row["bus_id"], []).append((n, row))
    found = []
    for buses in routes.values():
        for a, b in combinations(sorted(buses), 2):
            seen = _observations(sorted(buses[a] + buses[b], key=lambda x: x[0]))
            for close, stretch in groupby(seen, lambda o: o[2] <= distance_m):
                timer = None
                for n, row, dist in stretch if close else ():
                    if timer is None:
                        timer = row["ts_ms"]
                    elif row["ts_ms"] - timer > duration_ms:
                        found.append((n, a, b, dist, row["ts_ms"] - timer))
                        timer = row["ts_ms"]
    return [(rows[n]["event_id"], *rest) for n, *rest in sorted(found)]


def _observations(events):
    """(n, row, distance) at each event of a pair from which both buses have a position."""
    last = {}
    for n, row in events:
        last[row["bus_id"]] = (row["lat"], row["lon"])
        if len(last) == 2:
            yield n, row, haversine_m(*(x for p in last.values() for x in p))

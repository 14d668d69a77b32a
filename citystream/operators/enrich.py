"""Stream-table enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.operators.joins import broadcast_if_small, latest_per_key

SCHEDULE_FIELDS = ("route_name", "scheduled_arrival_time", "terminal")


def route_table(schedule: DataFrame, order_col: str = "seq") -> DataFrame:
    """Route lookup as a table — the last row of a duplicated route_id wins."""
    return latest_per_key(schedule.select("route_id", *SCHEDULE_FIELDS, order_col),
                          "route_id", order_col)


def enrich_bus_gps(gps: DataFrame, routes: DataFrame) -> DataFrame:
    """Left outer equi-join of every GPS event to its route's schedule.

    Unmatched (or null) routes get route_name/terminal 'UNKNOWN' and a null
    arrival time; each event is emitted exactly once because the table side
    is unique per route_id. The route table is broadcast after a size check.
    """
    r = broadcast_if_small(routes.select("route_id", *SCHEDULE_FIELDS))
    # Table fields overwrite same-named stream fields.
    g = gps.drop(*[c for c in SCHEDULE_FIELDS if c in gps.columns])
    j = g.join(r, "route_id", "left")
    return j.select(
        *[c for c in g.columns],
        F.coalesce("route_name", F.lit("UNKNOWN")).alias("route_name"),
        F.col("scheduled_arrival_time"),
        F.coalesce("terminal", F.lit("UNKNOWN")).alias("terminal"))

"""Streaming twins of the sequence detectors.

Keyed state lives in Spark's state store (checkpointed, so a restarted
query resumes with it). Within a micro-batch a key's rows are sorted by
(event_time, event_id) before folding; across micro-batches arrival order
holds, as in the original per-key stream processing. The ``in_order`` forms
hold rows until the watermark has passed them instead (``event_order.py``), so
arrival disorder within its delay changes nothing. No detector drops late rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from citystream.config import (BUNCHING_DISTANCE_M, BUNCHING_DURATION_SEC, BUS_BUNCHING, EARTH_RADIUS_M,
                               GRIDLOCK_CYCLES, GRIDLOCK_WAIT_SEC, TRAFFIC_GRIDLOCK)
from citystream.functions.numeric import round_ratio
from citystream.functions.timefn import epoch_millis
from citystream.operators.bunching import Grid
from citystream.session import prepare
from citystream.streaming.event_order import NO_TIME, in_event_order

GRIDLOCK_OUT = ("incident_type string, junction_id string, zone string, avg_wait_sec double, "
                "consecutive_cycles int, detected_from_timestamp string, event_time timestamp, event_id long")


def _sorted(pdfs) -> pd.DataFrame:
    pdf = pd.concat(list(pdfs), ignore_index=True)
    return pdf.sort_values(["event_time", "event_id"], na_position="first", kind="stable")


def _streaks(over: np.ndarray, carry: int, cycles: int) -> tuple[np.ndarray, int]:
    """Which rows alert, and the streak left. Run position = rows since the last
    calm row; a run still open from before continues the carried streak."""
    idx = np.arange(1, len(over) + 1)
    last_calm = np.maximum.accumulate(np.where(~over, idx, 0))
    pos = idx - last_calm + np.where(last_calm == 0, carry, 0)
    end = int(pos[-1]) if len(over) and over[-1] else 0
    return over & (pos % cycles == 0), end % cycles


def gridlock_stream(signals: DataFrame, wait_sec: float = GRIDLOCK_WAIT_SEC,
                    cycles: int = GRIDLOCK_CYCLES) -> DataFrame:
    """T4: per junction a ValueState streak counter (reset on a calm cycle
    and after each alert). Within a micro-batch the counter is computed as
    a vectorised run position, so alerts fall on multiples of ``cycles``."""

    def step(key, pdfs, state):
        pdf = _sorted(pdfs)
        wait = pdf["avg_wait_sec"].fillna(0.0).to_numpy(float)
        hit, end = _streaks(wait > wait_sec, state.get[0] if state.exists else 0, cycles)
        state.update((end,))
        out = pdf.loc[hit]
        yield pd.DataFrame({
            "incident_type": TRAFFIC_GRIDLOCK, "junction_id": out["junction_id"], "zone": out["zone"],
            "avg_wait_sec": wait[hit], "consecutive_cycles": cycles, "detected_from_timestamp": out["timestamp"],
            "event_time": out["event_time"], "event_id": out["event_id"].astype("int64")})

    prepare(signals.sparkSession)
    rows = signals.select(F.coalesce("junction_id", F.lit("UNKNOWN")).alias("_key"), "junction_id", "zone",
                          "avg_wait_sec", "timestamp", "event_time", "event_id")
    return rows.groupBy("_key").applyInPandasWithState(
        step, GRIDLOCK_OUT, "streak int", "append", GroupStateTimeout.NoTimeout)


def _distances(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Great-circle distances in metres of arrays of points."""
    half = [np.sin(np.radians(b - a) / 2) ** 2 for a, b in ((lat1, lat2), (lon1, lon2))]
    chord = half[0] + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * half[1]
    return 2.0 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, chord)))


class Streak(StatefulProcessor):
    """Per junction a ValueState streak counter, over rows in event order."""

    def __init__(self, wait_sec: float, cycles: int):
        self.wait_sec, self.cycles = wait_sec, cycles

    def init(self, handle) -> None:
        self.streak = handle.getValueState("streak", "streak int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["turn", "us", "event_id"], kind="stable")
        carry = self.streak.get()
        hit, end = _streaks(pdf["avg_wait_sec"].fillna(0.0).to_numpy(float) > self.wait_sec, carry[0] if carry else 0, self.cycles)
        self.streak.update((end,))
        yield pdf.loc[hit, ["junction_id", "zone", "avg_wait_sec", "timestamp", "us", "event_id"]]

    def close(self) -> None:
        pass


def gridlock_in_order(signals: DataFrame, wait_sec: float = GRIDLOCK_WAIT_SEC, cycles: int = GRIDLOCK_CYCLES,
                      in_order: bool = True) -> DataFrame:
    """T4 over event time (T2): as :func:`gridlock_stream`, but a junction's
    cycles are counted in event-time order whatever order they arrive in, once
    the watermark has passed them. ``signals`` needs a watermark. With
    ``in_order`` off they are counted as they arrive, by operators that, unlike
    those of :func:`gridlock_stream`, may stand beside others in one query."""
    prepare(signals.sparkSession)
    rows = signals.withColumn("_key", F.coalesce("junction_id", F.lit("UNKNOWN")))
    ordered = in_event_order(rows, ["_key"], ["junction_id", "zone", "avg_wait_sec", "timestamp"], [], in_order, "gridlock_order")
    hits = ordered.groupBy("_key").transformWithStateInPandas(
        Streak(wait_sec, cycles), "junction_id string, zone string, avg_wait_sec double, timestamp string, us long, event_id long",
        "append", "none")
    return hits.select(F.lit(TRAFFIC_GRIDLOCK).alias("incident_type"), "junction_id", "zone",
                       F.coalesce("avg_wait_sec", F.lit(0.0)).alias("avg_wait_sec"),
                       F.lit(cycles).alias("consecutive_cycles"), F.col("timestamp").alias("detected_from_timestamp"),
                       _event_time(), "event_id")


def _event_time():
    return F.when(F.col("us") > NO_TIME, F.timestamp_micros("us")).alias("event_time")


#: Cells of a block a side: few keys, few events that concern several.
CELLS = 8


class CellNeighbours(StatefulProcessor):
    """T5, Y2: per (route, block of grid cells) a MapState of the buses whose
    latest position lies there. A row is a bus's event that may meet them (``probe``),
    that brings the bus here (``own``) or takes it away. Emits the pair's close
    observations, each with the order of the pair's previous observation: the
    later of this bus's previous event and the other's latest one."""

    OUT = ("route_id string, bus_a string, bus_b string, dist double, turn long, us long, event_id long, ms long, "
           "timestamp string, q_turn long, q_us long, q_id long")

    def __init__(self, limit: float, ttl_ms: int | None):
        self.limit, self.ttl_ms = limit, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.buses = handle.getMapState("buses", "bus_id string", "lat double, lon double, turn long, us long, id long, ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["turn", "us", "event_id"], kind="stable")
        there = {k[0]: tuple(v) for k, v in self.buses.iterator()}
        place = {b: i for i, b in enumerate(there)}
        names = list(there)
        # Coordinates and times by place; nan for a bus that has left.
        grown = len(names) + len(pdf)
        at = np.full((grown, 2), np.nan)
        seen = np.zeros(grown, np.int64)
        for b, i in place.items():
            at[i], seen[i] = there[b][:2], there[b][5]
        changed, out = set(), []
        columns = ["bus_id", "lat", "lon", "turn", "us", "event_id", "ms", "probe", "own", "p_turn", "p_us", "p_event_id", "route_id", "timestamp"]
        for bus, lat, lon, turn, us, event, ms, probe, own, p_turn, p_us, p_id, route, text in zip(*(pdf[c].tolist() for c in columns)):
            if probe and names:
                n = len(names)
                dist = _distances(lat, lon, at[:n, 0], at[:n, 1])
                near = dist <= self.limit
                if self.ttl_ms is not None:
                    near &= seen[:n] >= ms - self.ttl_ms
                for i in np.flatnonzero(near).tolist():
                    other = names[i]
                    if other != bus:
                        before = max((p_turn, p_us, p_id) if p_turn >= 0 else (-1, NO_TIME, -1), there[other][2:5])
                        a, b = (bus, other) if bus < other else (other, bus)
                        out.append((route, a, b, float(dist[i]), turn, us, event, ms, text, *before))
            if own:
                if bus not in place:
                    place[bus] = len(names)
                    names.append(bus)
                at[place[bus]], seen[place[bus]] = (lat, lon), ms
                there[bus] = (lat, lon, turn, us, event, ms)
                changed.add(bus)
            elif bus in there:
                at[place[bus]] = np.nan
                del there[bus]
                changed.add(bus)
        for bus in changed:
            if bus in there:
                self.buses.updateValue((bus,), there[bus])
            elif self.buses.containsKey((bus,)):
                self.buses.removeKey((bus,))
        if self.ttl_ms is not None and there:
            self.handle.registerTimer(max(0, min(v[5] for v in there.values())) + self.ttl_ms + 1)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in self.OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() - self.ttl_ms
        there = {k[0]: v[5] for k, v in self.buses.iterator()}
        for bus, ms in there.items():
            if ms < passed:
                self.buses.removeKey((bus,))
        left = [ms for ms in there.values() if ms >= passed]
        if left:
            self.handle.registerTimer(min(left) + self.ttl_ms + 1)
        return iter(())

    def close(self) -> None:
        pass


class PairTimer(StatefulProcessor):
    """Per pair of buses the timer of its run of close observations and
    its last one. A run goes on if the pair's previous observation was that one."""

    def __init__(self, d: int, ttl_ms: int | None):
        self.d, self.ttl_ms = d, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "timer long, turn long, us long, id long, ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["turn", "us", "event_id"], kind="stable").reset_index(drop=True)
        timer, *last, seen = self.run.get() or (0, None, None, None, 0)
        last, hits, elapsed = tuple(last), [], []
        for i, (turn, us, event, ms, *before) in enumerate(zip(*(pdf[c].tolist() for c in ("turn", "us", "event_id", "ms", "q_turn", "q_us", "q_id")))):
            if tuple(before) != last or (self.ttl_ms is not None and ms - seen > self.ttl_ms):
                timer = ms
            elif ms - timer > self.d:
                hits.append(i)
                elapsed.append(ms - timer)
                timer = ms
            last, seen = (turn, us, event), ms
        self.run.update((timer, *last, seen))
        if self.ttl_ms is not None:
            self.handle.registerTimer(max(0, seen) + self.ttl_ms + 1)
        if hits:
            yield pdf.loc[hits, ["route_id", "bus_a", "bus_b", "dist", "us", "event_id", "timestamp"]].assign(elapsed_ms=elapsed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run = self.run.get()
        if run is not None and run[4] < timerValues.getCurrentWatermarkInMs() - self.ttl_ms:
            self.run.clear()
        return iter(())

    def close(self) -> None:
        pass


def bunching_stream(gps: DataFrame, distance_m: float = BUNCHING_DISTANCE_M, duration_sec: int = BUNCHING_DURATION_SEC,
                    ttl_sec: int | None = None, in_order: bool = False) -> DataFrame:
    """T5: three keyed operators in one query, none of which holds a route.

    By bus: the previous event, and with ``in_order`` (and a watermark on
    ``gps``) event-time order whatever order rows arrive in; else arrival order.
    By route and block of ``CELLS`` x ``CELLS`` grid cells: the buses there; an
    event meets those of the blocks that hold its own or a neighbouring cell
    (the grid of the batch operator, exact bounds), mostly a single one.
    By pair: the timer. State is one row per bus and per pair that has been
    close, spread over all tasks, whatever the size of a route.

    With ``ttl_sec`` (D13; ``gps`` then needs a watermark) a position older than
    that isn't met and a pair not seen close for longer begins anew; event-time
    timers remove both. By default state never expires, as in the rule."""
    prepare(gps.sparkSession)
    d, ttl_ms = int(duration_sec) * 1000, None if ttl_sec is None else int(ttl_sec) * 1000
    rows = (gps.where("bus_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
            .withColumn("_rk", F.coalesce("route_id", F.lit("UNKNOWN"))).withColumn("ms", F.coalesce(epoch_millis("event_time"), F.lit(0).cast("long"))))
    ordered = in_event_order(rows, ["_rk", "bus_id"], ["route_id", "lat", "lon", "ms", "timestamp"], ["lat", "lon"], in_order, "bunching_order")
    grid, mode = Grid(distance_m), "none" if ttl_ms is None else "eventTime"
    block = lambda c: F.struct(F.floor(c["band"] / CELLS).alias("band"), F.floor(c["lc"] / CELLS).alias("lc"))
    spots = (ordered.withColumn("near", F.array_distinct(F.transform(grid.neighbour_cells(F.col("lat"), F.col("lon")), block)))
             .withColumn("own_block", block(grid.own_cell(F.col("lat"), F.col("lon"))))
             .withColumn("left_block", F.when(F.col("p_turn") >= 0, block(grid.own_cell(F.col("p_lat"), F.col("p_lon")))))
             .withColumn("at", F.explode(F.array_union("near", F.array_compact(F.array("own_block", "left_block")))))
             .withColumn("probe", F.array_contains("near", F.col("at"))).withColumn("own", F.col("at") == F.col("own_block"))
             # What a null looks like in pandas is no matter: these are read only where p_turn >= 0.
             .fillna(NO_TIME, ["p_us"]).fillna(-1, ["p_event_id"])
             .select("_rk", F.col("at.band").alias("band"), F.col("at.lc").alias("lc"), "route_id", "bus_id", "lat", "lon", "us", "event_id",
                     "ms", "timestamp", "turn", "probe", "own", "p_turn", "p_us", "p_event_id"))
    close = spots.groupBy("_rk", "band", "lc").transformWithStateInPandas(CellNeighbours(distance_m, ttl_ms), CellNeighbours.OUT, "append", mode)
    alerts = (close.withColumn("_rk", F.coalesce("route_id", F.lit("UNKNOWN"))).groupBy("_rk", "bus_a", "bus_b")
              .transformWithStateInPandas(PairTimer(d, ttl_ms), "route_id string, bus_a string, bus_b string, dist double, us long, event_id long, "
                                          "timestamp string, elapsed_ms long", "append", mode))
    return alerts.select(F.lit(BUS_BUNCHING).alias("incident_type"), "route_id", "bus_a", "bus_b",
                         F.round("dist", 1).alias("distance_m"),
                         round_ratio(F.col("elapsed_ms"), 60000, 1).alias("minutes_close"),
                         F.col("timestamp").alias("detected_from_timestamp"), _event_time(), "event_id")

"""Event-time order in streams (T2, D5): a reorder buffer per key.

Rows that arrive out of order are held in a ``ListState`` until the watermark
has passed them, and are then handed on in (event_time, event_id) order. All
keys release by the one watermark of the query, so what a micro-batch releases
lies, for every key, after all that earlier ones released: an operator behind
it, keyed otherwise, sees the whole stream in event-time order by sorting each
micro-batch. Arrival disorder within the watermark's delay then changes nothing.

A row that arrives behind the watermark isn't dropped: it is handed on at once,
marked ``late`` (and counted by :func:`in_event_order`). Rows without an event
time sort before all others and are handed on at once too.

Every row also carries what its key's previous row was (``previous`` columns),
which operators keyed by place need to know where a thing came from.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Stands for a null event time, which sorts first.
NO_TIME = -(1 << 62)


class InEventOrder(StatefulProcessor):
    """Per key: ``held`` rows (if ``hold``) and the ``last`` row handed on.

    ``columns`` are the rows' columns, (us, event_id) first; ``previous`` the
    ones repeated from the row before, by their places. A row's ``turn`` is the
    time of the micro-batch that handed it on: (turn, us, event_id) is the
    order in which the query works."""

    def __init__(self, key: list[str], columns: list[tuple[str, str]], previous: list[str], hold: bool):
        self.key, self.columns, self.hold = key, columns, hold
        self.previous = [[c for c, _ in columns].index(p) for p in previous]
        self.names = [*key, *(c for c, _ in columns), "turn", "late", "p_turn", *(f"p_{p}" for p in previous)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = ", ".join(f"{c} {t}" for c, t in self.columns)
        self.handle = handle
        self.last = handle.getValueState("last", f"turn long, {schema}")
        if self.hold:
            self.held = handle.getListState("held", schema)

    def _give(self, key: tuple, rows: list[tuple], turn: int, watermark_us: int | None) -> pd.DataFrame:
        before = self.last.get()
        out = []
        for row in rows:
            old = (-1, *(None for _ in self.previous)) if before is None else (before[0], *(before[1 + i] for i in self.previous))
            out.append((*key, *row, turn, watermark_us is not None and NO_TIME < row[0] < watermark_us, *old))
            before = (turn, *row)
        self.last.update(before)
        return pd.DataFrame(out, columns=self.names).astype(object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [*(c for c, _ in self.columns), *([] if self.hold else ["arrived"])]
        came = [r for pdf in rows for r in zip(*(pdf[c].tolist() for c in names))]
        came.sort(key=lambda r: r[:2])
        if not self.hold:
            yield self._give(key, [r[:-1] for r in came], came[0][-1], None)
            return
        turn = timerValues.getCurrentProcessingTimeInMs()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        now = [r for r in came if r[0] < passed]
        later = came[len(now):]
        if now:
            yield self._give(key, now, turn, passed)
        if later:
            self.held.appendList(later)
            self.handle.registerTimer(later[0][0] // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted(self.held.get(), key=lambda r: r[:2])
        now = [tuple(r) for r in held if r[0] < passed]
        later = [tuple(r) for r in held[len(now):]]
        if not now:
            return  # another of the key's timers has released them
        if later:
            self.held.put(later)
            self.handle.registerTimer(later[0][0] // 1000 + 1)
        else:
            self.held.clear()
        yield self._give(key, now, timerValues.getCurrentProcessingTimeInMs(), None)

    def close(self) -> None:
        pass


def in_event_order(rows: DataFrame, key: list[str], columns: list[str], previous: list[str], hold: bool, metric: str = "event_order") -> DataFrame:
    """``rows`` (with a watermark on ``event_time`` if ``hold``) per ``key`` in
    event-time order, or with ``hold`` off in arrival order, sorted within a
    micro-batch: the key, ``us`` (event time in microseconds), event_id,
    ``columns``, ``turn``, ``late``, and of the key's previous row ``p_turn``
    (-1 if there was none), ``p_us``, ``p_event_id`` and ``previous``. The
    query's progress counts the rows and the late ones under ``metric``."""
    kinds = dict(rows.dtypes)
    us = F.coalesce(F.unix_micros("event_time"), F.lit(NO_TIME)).alias("us")
    # The time column itself stays behind: with it Spark would drop late rows.
    narrow = rows.select(*key, us, "event_id", *columns, *([] if hold else [F.unix_millis(F.current_timestamp()).alias("arrived")]))
    shape = [("us", "long"), ("event_id", "long"), *((c, kinds[c]) for c in columns)]
    back = ["us", "event_id", *previous]
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), *(f"{c} {t}" for c, t in shape), "turn long, late boolean, p_turn long",
                        *(f"p_{c} {dict(shape)[c]}" for c in back)])
    ordered = narrow.groupBy(*key).transformWithStateInPandas(
        InEventOrder(key, shape, back, hold), schema, "append", "eventTime" if hold else "none")
    return ordered.observe(metric, F.count("*").alias("rows"), F.count_if("late").alias("late"))

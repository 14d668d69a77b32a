"""The restart timer of one pair, split by time chunks (W5), over arrays.

Rule: close observations form runs; a run's first observation starts the timer,
an observation more than ``d`` after the timer alerts and restarts it.

A chunk holds a pair's close observations of one stretch of time, in order:
times ``ts``, ids, and the id of each row's predecessor observation. A run goes
on over a row if its predecessor is the close row before it.

* :func:`summarize` (parallel): what a later chunk needs to know, whatever
  timer is carried in.
* :func:`compose`: the summary of two neighbouring stretches, so that summaries
  merge in rounds and no pair's history has to be folded in one place.
* :func:`resolve` (a few summaries in order): the timer carried in.
* :func:`replay` (parallel): the chunk's alerts, given that timer.

Most chunks are short: :func:`summarize_all` and :func:`replay_all` take many at
once, in a few array operations over all their rows.
"""

from __future__ import annotations

import numpy as np

NONE = np.empty(0, np.int64)


def _layout(key, ids, preds, firsts: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of several chunks on end, which begin at the rows ``firsts``: where runs begin (chunks begin one), the end of
    each row's run, and the row that alerts after a (re)start at each row (the row itself if none). ``key`` orders the
    rows by chunk and time, chunks more than ``d`` apart."""
    new = np.append(True, preds[1:] != ids[:-1])
    new[firsts] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(ids))[np.cumsum(new) - 1]
    after = np.searchsorted(key, key + d, "right")
    return new, ends, np.where(after < ends, after, np.arange(len(key)))


def _last_alert(following: np.ndarray) -> np.ndarray:
    """Where the alerts that follow a (re)start at each row end: pointers doubled."""
    while not np.array_equal(further := following[following], following):
        following = further
    return following


def keys_of(ts: np.ndarray, firsts: np.ndarray, chunk_starts: np.ndarray, d: int) -> np.ndarray:
    """Sort keys of chunks on end: the time since the chunk's start, chunks more than ``d`` apart."""
    sizes = np.diff(np.append(firsts, len(ts)))
    since = ts - np.repeat(chunk_starts, sizes)
    low = int(since.min())
    return since - low + np.repeat(np.arange(len(firsts)), sizes) * (int(since.max()) - low + d + 1)


def summarize_all(ts, ids, preds, firsts, chunk_starts, d: int) -> dict:
    """The columns of :func:`summarize` for several chunks on end, which begin
    at the rows ``firsts``; ``cand_ts`` and ``cand_exit`` hold all chunks'
    values, ``cand_n`` how many each has."""
    key = keys_of(ts, firsts, chunk_starts, d)
    new, _, following = _layout(key, ids, preds, firsts, d)
    exits = ts[_last_alert(following)]
    lasts = np.append(firsts[1:], len(ts))
    chunk = np.repeat(np.arange(len(firsts)), lasts - firsts)
    starts = np.flatnonzero(new)
    # Of a chunk's runs, the first begins with it: its end is where the second begins.
    first_run = np.searchsorted(starts, firsts)
    first_end = np.append(starts[1:], len(ts))[first_run]
    last_start = starts[np.searchsorted(starts, lasts) - 1]
    inside = last_start > firsts
    soon = np.add.reduceat((ts - chunk_starts[chunk] <= d).astype(np.int64), firsts)
    n = np.minimum(first_end, firsts + soon + 1)
    cand = np.arange(len(ts)) < n[chunk]
    edge = np.append(exits[1:] != exits[:-1], True)
    edge[n - 1] = True
    cand &= edge
    return {
        "first_pred": preds[firsts], "last_id": ids[lasts - 1], "has_local_start": inside,
        "det_exit": np.where(inside, exits[last_start], 0), "start_exit": exits[firsts],
        "cand_n": np.add.reduceat(cand.astype(np.int64), firsts), "cand_ts": ts[cand], "cand_exit": exits[cand],
    }


def summarize(ts, ids, preds, d: int, chunk_start: int) -> dict:
    """``det_exit``: timer at the end of the last run that starts inside;
    ``start_exit``: timer at the end of the first run if it starts with the
    chunk; ``cand_ts``, ``cand_exit``: the same if it goes on from before, by
    the first row later than the carried timer plus ``d``. The timer is from
    before the chunk, so only rows up to ``chunk_start + d`` can be that row;
    neighbours with one outcome are merged, each entry naming its last row's time."""
    ts, ids, preds = map(np.asarray, (ts, ids, preds))
    out = summarize_all(ts, ids, preds, np.zeros(1, np.int64), np.array([chunk_start], np.int64), d)
    del out["cand_n"]
    return {k: v if k.startswith("cand") else v[0].item() for k, v in out.items()}


def resolve(goes_on: bool, timer: int, row: dict, d: int) -> int:
    """The timer after a chunk, from its summary and, if its first run
    ``goes_on`` from before, the timer carried in."""
    if row["has_local_start"]:
        return row["det_exit"]
    if not goes_on:
        return row["start_exit"]
    k = int(np.searchsorted(row["cand_ts"], timer + d, "right"))
    return int(row["cand_exit"][k]) if k < len(row["cand_ts"]) else timer


def compose(a: dict, b: dict, d: int, start: int) -> dict:
    """The summary of stretch ``a`` (which begins at ``start``) and the stretch
    ``b`` after it, as one: what :func:`resolve` says of it is what it says of
    the two in turn. Entries later than ``start + d`` but for the first can't
    be met and are left out, so a summary never grows with the stretch."""
    goes_on = b["first_pred"] == a["last_id"]

    def through(timer: int) -> int:
        return resolve(goes_on, timer, b, d)

    whole = {"first_pred": a["first_pred"], "last_id": b["last_id"], "start_exit": through(a["start_exit"]),
             "has_local_start": a["has_local_start"] or not goes_on or b["has_local_start"], "det_exit": 0}
    if whole["has_local_start"]:
        # From the last start on, what was carried in no longer matters.
        return {**whole, "det_exit": through(a["det_exit"]), "cand_ts": NONE, "cand_exit": NONE}
    ts = np.concatenate([a["cand_ts"], b["cand_ts"]]).astype(np.int64)
    exits = np.concatenate([[through(int(e)) for e in a["cand_exit"]], b["cand_exit"]]).astype(np.int64)
    n = min(len(ts), int(np.searchsorted(ts, start + d, "right")) + 1)
    last = np.append(exits[1:n] != exits[:n - 1], True)
    return {**whole, "cand_ts": ts[:n][last], "cand_exit": exits[:n][last]}


def replay_all(ts, ids, preds, firsts, chunk_starts, goes_on, timers, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, elapsed times) of every alert of several chunks on end, which
    begin at the rows ``firsts`` and are entered with ``timers``."""
    key = keys_of(ts, firsts, chunk_starts, d)
    new, ends, following = _layout(key, ids, preds, firsts, d)
    # The first run of a chunk that goes on alerts first at the first row later than the carried timer plus d.
    on = np.flatnonzero(goes_on)
    at = key[firsts[on]] - ts[firsts[on]]  # from times to keys, chunk by chunk
    lowest, highest = key[firsts[on]] - 1, key[np.append(firsts[1:], len(ts))[on] - 1]
    entered = np.searchsorted(key, np.clip(timers[on] + d + at, lowest, highest), "right")
    alerts = entered < ends[firsts[on]]
    rows, elapsed = [entered[alerts]], [ts[entered[alerts]] - timers[on][alerts]]
    new[firsts[on]] = False
    at_row = np.concatenate([np.flatnonzero(new), rows[0]])
    while len(at_row := at_row[following[at_row] != at_row]):
        after = following[at_row]
        rows.append(after)
        elapsed.append(ts[after] - ts[at_row])
        at_row = after
    rows, elapsed = np.concatenate(rows), np.concatenate(elapsed)
    order = np.argsort(rows, kind="stable")
    return rows[order], elapsed[order]


def replay(ts, ids, preds, d: int, goes_on: bool, timer: int) -> list[tuple[int, int]]:
    """(row, elapsed) of every alert in the chunk."""
    ts, ids, preds = map(np.asarray, (ts, ids, preds))
    rows, elapsed = replay_all(ts, ids, preds, np.zeros(1, np.int64), ts[:1], np.array([goes_on]), np.array([timer], np.int64), d)
    return list(zip(rows.tolist(), elapsed.tolist()))

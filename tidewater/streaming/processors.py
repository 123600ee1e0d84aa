"""Keyed state processors for ``transformWithStateInPandas``.

Each processor receives, per micro-batch and key, Arrow batches as pandas
frames, sorts them by the arrival sequence (a micro-batch does not keep the
order inside it), updates its state in one vectorized pass and emits rows.
State lives in the RocksDB state store and is checkpointed with the query.
Values are summed as integers of 1 / ``UNITS`` so results are exact; null values count as rows only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# The processors are the only library code that runs in Python workers. Ship
# them with the query (pickled by value), so executors need numpy, pandas and
# pyspark but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _frame(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    parts = list(rows)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return pdf.sort_values(order, kind="stable").reset_index(drop=True)


UNITS = 1_000_000_000   # values have nine decimal places, as in the batch sums; a window's sum may reach 9.2 * 10^9


class _Book:
    """Helpers for a key's state kept as one value row of arrays plus the time
    of the one armed timer (one read and one write per key and batch)."""

    @staticmethod
    def arm(handle: StatefulProcessorHandle, armed: int | None, want: int | None) -> int | None:
        if armed == want:
            return armed
        if armed is not None:
            handle.deleteTimer(int(armed))
        if want is not None:
            handle.registerTimer(int(want))
        return want


class OrderTimeoutProcessor(StatefulProcessor):
    """Orders wait ``interval_ms`` for a review of the same key.

    Input rows: ``(kind, order_id, ms)`` with kind ``order`` or ``review``.
    Pending orders are kept in one value per key (arrays); reviews of a
    micro-batch mark the pending orders they fall in ``(ts, due]`` in one
    vectorized pass. One event-time timer per key stands at the earliest due
    time; when it fires, every order whose due time the watermark has passed
    is emitted (``reviewed`` / ``auto_good_review``) and the timer moves to the
    next due time. State work per key and batch is a constant number of state
    calls, not one per order.

    ``drain_all=True`` is the literal variant: each order sets a timer, and a
    timer hands *all* pending orders of the key that arrived before it (a
    timer fires before an order of the same instant). The future timer times
    are kept with the orders behind the same single armed timer; when it
    fires, each pending order is handled by the first passed timer time after it.
    """

    SCHEMA = "order_id array<long>, ms array<long>, reviewed array<boolean>, due array<long>, reviews array<long>, armed long"

    def __init__(self, key: str, interval_ms: int, drain_all: bool = False):
        self.key, self.interval, self.drain_all = key, interval_ms, drain_all

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", self.SCHEMA)

    def _load(self):
        b = self.book.get()
        if b is None:
            return (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, bool), np.zeros(0, "int64"),
                    np.zeros(0, "int64"), None)
        return (np.array(b[0], dtype="int64"), np.array(b[1], dtype="int64"), np.array(b[2], dtype=bool),
                np.array(b[3], dtype="int64"), np.array(b[4], dtype="int64"), b[5])

    def _store(self, oid, ms, rev, due, reviews, armed) -> None:
        if len(oid) or len(due) or len(reviews):
            self.book.update((oid.tolist(), ms.tolist(), rev.tolist(), due.tolist(), reviews.tolist(), armed))
        else:
            self.book.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, "ms")
        is_order = (pdf["kind"] == "order").to_numpy()
        oid, ms, rev, due, reviews, armed = self._load()
        new_ms = pdf["ms"].to_numpy(dtype="int64")[is_order]
        oid = np.concatenate([oid, pdf["order_id"].to_numpy(dtype="int64")[is_order]])
        ms = np.concatenate([ms, new_ms])
        rev = np.concatenate([rev, np.zeros(len(new_ms), dtype=bool)])
        if self.drain_all:
            due = np.concatenate([due, new_ms + self.interval])
            want = int(due.min()) if len(due) else None
        else:
            reviews = np.sort(np.concatenate([reviews, pdf["ms"].to_numpy(dtype="int64")[~is_order]]))
            if len(reviews) and len(ms):
                nxt = np.searchsorted(reviews, ms, side="right")   # first review strictly after the order
                has = nxt < len(reviews)
                hit = np.zeros(len(ms), dtype=bool)
                hit[has] = reviews[nxt[has]] <= ms[has] + self.interval
                rev = rev | hit
            # an order that is still to come is not older than the watermark
            reviews = reviews[reviews > timerValues.getCurrentWatermarkInMs()]
            want = self._next(ms, reviews)
        armed = _Book.arm(self.handle, armed, want)
        self._store(oid, ms, rev, due, reviews, armed)
        return iter([])

    def _next(self, ms, reviews) -> int | None:
        """The timer to arm: the earliest due time, or, with reviews only, the time the last of them is of no use."""
        if len(ms):
            return int(ms.min()) + self.interval
        return int(reviews.max()) if len(reviews) else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        oid, ms, rev, due, reviews, _ = self._load()
        armed = None                                   # the armed timer has just fired
        if self.drain_all:
            passed, due = due[due <= limit], due[due > limit]
            idx = np.searchsorted(np.sort(passed), ms, side="right")   # first passed timer after the order
            take = idx < len(passed)
            handled = np.sort(passed)[idx[take]]
            want = int(due.min()) if len(due) else None
        else:
            take = ms + self.interval <= limit
            handled = ms[take] + self.interval
            reviews = reviews[reviews > timerValues.getCurrentWatermarkInMs()]
            want = self._next(ms[~take], reviews)
        done = (oid[take], ms[take], rev[take])
        armed = _Book.arm(self.handle, armed, want)
        self._store(oid[~take], ms[~take], rev[~take], due, reviews, armed)
        if not len(done[0]):
            return iter([])
        status = np.where(done[2], "reviewed", "auto_good_review")
        return iter([pd.DataFrame({"order_id": done[0], self.key: key[0], "order_ms": done[1],
                                   "handled_ms": handled.astype("int64"), "status": status})])

    def close(self) -> None:
        pass


class LateWindowProcessor(StatefulProcessor):
    """Tumbling event-time windows per user, with allowed lateness and a late side output.

    The key is a bucket of many users, so a micro-batch costs a few state calls per bucket and not per user; the users without
    an id are the bucket ``NO_USER``. Input rows ``(user_id, arrival, event_id, ms, units, valued)`` (``units`` 0 where
    ``valued`` is 0); the watermark is the engine's (max event time of earlier micro-batches minus the bound). At the
    start of a batch, windows the watermark has passed emit their on-time
    result (``firing = 0``). Rows of open windows accumulate; rows of passed
    windows within ``lateness_ms`` re-fire the window (``firing = 1, 2, ...``,
    arrival order); later rows are emitted with ``firing = -1`` (side output).
    State, one value per bucket: the windows as one table of integers (packed, a column per window, ordered by user and end)
    and the one armed event-time timer (at the earliest unfired window end). Frames are worked off one by one: of a
    bucket's rows only the accepted late ones are held together, as they are put in arrival order.
    """

    SCHEMA = "windows binary, armed long"
    USER, END, COUNT, SUM, VALUED, LATE, FIRED = range(7)
    NO_USER = -1

    def __init__(self, window_ms: int, lateness_ms: int):
        self.window, self.lateness = window_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", self.SCHEMA)

    def _load(self) -> tuple[np.ndarray, int | None]:
        b = self.book.get()
        if b is None:
            return np.zeros((7, 0), dtype="int64"), None
        return np.frombuffer(b[0], dtype="int64").reshape(7, -1).copy(), b[1]

    def _save(self, wins: np.ndarray, wm: int, armed: int | None) -> None:
        wins = wins[:, (wins[self.FIRED] == 0) | (wins[self.END] + self.lateness > wm)]
        unfired = wins[self.END][wins[self.FIRED] == 0]
        armed = _Book.arm(self.handle, armed, int(unfired.min()) if len(unfired) else None)
        if wins.shape[1]:
            self.book.update((np.ascontiguousarray(wins).tobytes(), armed))
        else:
            self.book.clear()

    def _merged(self, tables: list[np.ndarray]) -> np.ndarray:
        """One column per window: counts and sums added up (whole numbers, exact), fired if it is in any table."""
        wins = np.concatenate(tables, axis=1)
        wins = wins[:, np.lexsort((wins[self.END], wins[self.USER]))]
        first = self._starts(wins)
        if len(first) == wins.shape[1]:
            return wins
        out = wins[:, first]
        out[self.COUNT:self.FIRED] = np.add.reduceat(wins[self.COUNT:self.FIRED], first, axis=1)
        out[self.FIRED] = np.maximum.reduceat(wins[self.FIRED], first)
        return out

    def _starts(self, rows: np.ndarray) -> np.ndarray:
        """Where another window begins; ``rows`` in the order of user and end."""
        new = np.ones(rows.shape[1], dtype=bool)
        new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        return np.flatnonzero(new)

    def _fire_passed(self, wins: np.ndarray, wm: int, key) -> list[pd.DataFrame]:
        now = (wins[self.FIRED] == 0) & (wins[self.END] <= wm)
        wins[self.FIRED, now] = 1
        w = wins[:, now]
        return self._frame_out(key, w[self.USER], w[self.END], 0, w[self.COUNT], w[self.SUM], w[self.VALUED], -1)

    def _refire(self, wins: np.ndarray, late: list[np.ndarray], key) -> tuple[np.ndarray, list[pd.DataFrame]]:
        """Accepted late rows ``(user, end, arrival, id, units, valued)``: each re-fires its window, in arrival order, ties by id."""
        rows = np.concatenate(late, axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
        first = self._starts(rows)
        size = np.diff(np.append(first, rows.shape[1]))
        mine = np.repeat(np.arange(len(first)), size)
        # sums within the window: the running sum of all rows less that before the window (a wrap-around cancels out)
        running = np.cumsum(rows[4:], axis=1)
        running -= np.repeat(running[:, first] - rows[4:, first], size, axis=1)
        nth = np.arange(rows.shape[1]) - first[mine] + 1
        gone = np.zeros((7, len(first)), dtype="int64")
        gone[self.USER], gone[self.END], gone[self.FIRED] = rows[0, first], rows[1, first], 1
        wins = self._merged([wins, gone])                   # a window without any row so far has nothing to add to
        before = wins[:, self._find(wins, gone)][:, mine]
        out = self._frame_out(key, rows[0], rows[1], before[self.LATE] + nth, before[self.COUNT] + nth,
                              before[self.SUM] + running[0], before[self.VALUED] + running[1], rows[3])
        last = first + size - 1
        gone[self.COUNT], gone[self.LATE], gone[self.SUM], gone[self.VALUED] = size, size, running[0, last], running[1, last]
        return self._merged([wins, gone]), out

    def _find(self, wins: np.ndarray, some: np.ndarray) -> np.ndarray:
        """The places of windows that are all in ``wins``; both in the order of user and end."""
        both = np.concatenate([wins, some], axis=1)
        order = np.lexsort((np.arange(both.shape[1]) >= wins.shape[1], both[self.END], both[self.USER]))
        asked = order >= wins.shape[1]
        return np.cumsum(~asked)[asked] - 1

    def _frame_out(self, key, user, end, firing, n, units, valued, ids) -> list[pd.DataFrame]:
        if not len(user):
            return []
        users = pd.array(user, dtype="Int64")
        if key[0] == self.NO_USER:
            users[:] = pd.NA
        return [pd.DataFrame({"user_id": users, "window_end_ms": end, "firing": firing, "event_count": n, "sum_units": units,
                              "valued": valued, "event_id": ids})]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        wins, armed = self._load()
        out = self._fire_passed(wins, wm, key)
        tables, late = [wins], []
        for pdf in rows:
            user, arrival, ids, ms, units, valued = (pdf[c].to_numpy(dtype="int64") for c in
                                                     ("user_id", "arrival", "event_id", "ms", "units", "valued"))
            ends = ms - ms % self.window + self.window
            is_open = ends > wm
            is_late = ~is_open & (wm < ends + self.lateness)
            # rows of open windows: one count and sum per window
            one, none = np.ones(len(ms), dtype="int64"), np.zeros(len(ms), dtype="int64")
            tables.append(self._merged([np.stack([user, ends, one, units, valued, none, none])[:, is_open]]))
            late.append(np.stack([user, ends, arrival, ids, units, valued])[:, is_late])
            # beyond the allowed lateness: side output
            drop = ~is_open & ~is_late
            out += self._frame_out(key, user[drop], ends[drop], -1, 1, units[drop], valued[drop], ids[drop])
        wins = self._merged(tables)
        if any(r.shape[1] for r in late):
            wins, fired = self._refire(wins, late, key)
            out += fired
        self._save(wins, wm, armed)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        wins, _ = self._load()
        out = self._fire_passed(wins, wm, key)
        self._save(wins, wm, None)                     # the armed timer has just fired
        return iter(out)

    def close(self) -> None:
        pass


class DayTotalProcessor(StatefulProcessor):
    """The running total of a day at every tick, by a recurring event-time timer.

    Input rows ``(tick_ms, whole, nano, valued)`` of one key: the end of the tick that a sale falls in, and its price as a
    whole number and billionths. A timer stands at the next tick: when the watermark passes it, the open day's total is
    emitted and the timer is set to the tick after that, until the day's last tick closes the day and clears its total. Sales of
    ticks to come wait in the state, so it holds one day and the ticks ahead of the watermark, and nothing
    when all days are closed. Frames are added up one by one, so the rows of a key are never held together.
    """

    SCHEMA = "next_tick long, day_end long, whole long, nano long, ticks array<long>, wholes array<long>, nanos array<long>, armed long"

    def __init__(self, key: str, tick_ms: int, day_ms: int, offset_ms: int):
        self.key, self.tick, self.day, self.offset = key, tick_ms, day_ms, offset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", self.SCHEMA)

    def _load(self):
        b = self.book.get()
        if b is None:
            return None, None, 0, 0, {}, None
        return b[0], b[1], b[2], b[3], {t: [w, n] for t, w, n in zip(b[4], b[5], b[6])}, b[7]

    def _store(self, next_tick, day_end, whole, nano, ahead, armed) -> None:
        want = next_tick if next_tick is not None else min(ahead, default=None)
        armed = _Book.arm(self.handle, armed, want)
        if want is None:
            self.book.clear()
            return
        ticks = sorted(ahead)
        whole, nano = whole + nano // UNITS, nano % UNITS
        self.book.update((next_tick, day_end, whole, nano, ticks, [ahead[t][0] for t in ticks], [ahead[t][1] for t in ticks], armed))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        next_tick, day_end, whole, nano, ahead, armed = self._load()
        for pdf in rows:
            for t, part in pdf.groupby("tick_ms"):
                a = ahead.setdefault(int(t), [0, 0])
                more = a[1] + int(part["nano"].sum())
                ahead[int(t)] = [a[0] + int(part["whole"].sum()) + more // UNITS, more % UNITS]
        if next_tick is not None and ahead and min(ahead) < next_tick:
            next_tick = min(ahead)                     # a sale that came before its tick's timer
        self._store(next_tick, day_end, whole, nano, ahead, armed)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        next_tick, day_end, whole, nano, ahead, _ = self._load()
        out = []
        while True:
            if next_tick is None:                      # no day is open: the next sale opens one
                if not ahead:
                    break
                next_tick = min(ahead)
                day_end = -((self.offset - next_tick) // self.day) * self.day + self.offset
            if next_tick > limit:
                break
            w, n = ahead.pop(next_tick, (0, 0))
            whole, nano = whole + w + (nano + n) // UNITS, (nano + n) % UNITS
            out.append((key[0], next_tick, whole, nano))
            if next_tick >= day_end:
                next_tick, day_end, whole, nano = None, None, 0, 0
            else:
                next_tick += self.tick
        self._store(next_tick, day_end, whole, nano, ahead, None)         # the armed timer has just fired
        if not out:
            return iter([])
        pdf = pd.DataFrame(out, columns=[self.key, "tick_ms", "whole", "nano"])
        pdf["tick"] = pd.to_datetime(pdf["tick_ms"], unit="ms", utc=True)
        return iter([pdf[[self.key, "tick", "whole", "nano"]]])

    def close(self) -> None:
        pass

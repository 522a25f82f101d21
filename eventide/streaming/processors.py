"""Stateful processors for ``transformWithState``.

Rows of a key reach ``handleInputRows`` in any order within the watermark
delay.  Processors that depend on order keep the few fields they need in list
state, an entry of arrays for the rows of one micro-batch, until the watermark
has passed them; then no
earlier row can come, and they are walked in (ts, tie) order.  A timer that
is due before a row (``T < row.ts``) is fired inline, and one that the
watermark has passed is fired after the walk -- the same rule the batch twins
use.  One timer per key wakes the processor at its next waiting row or
deadline.  State per key is the rows within the delay plus O(1) -- or the
creates still inside their deadline (I5), or the switches that can still
matter (G5) -- held in the RocksDB state store and checkpointed with the query.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from operator import itemgetter

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

_NO_TIMER = -1
# Rows without a time come first.
_NO_TIME = -(1 << 62)
# Rows in one entry of a list state.
_ENTRY_ROWS = 4096


class DeadlineTimers(StatefulProcessor):
    """Every row sets an event-time deadline at ts + delay; each deadline
    that the watermark has passed fires once and emits (key, fire_ms).
    Deadlines are unique per (key, time); order does not matter.

    Runs over pandas batches (a string key, no row without a time), grouped by
    ``lane_of`` the key and the time.  The pending deadlines of a lane stand in
    list state as arrays, and one timer wakes the lane at its next one: a timer
    of the engine for each costs a row several calls to the state store."""

    def __init__(self, key: str, delay_ms: int, ts: str = "ts_ms"):
        self.key, self.delay, self.ts = key, delay_ms, ts

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "keys array<string>, fire_ms array<long>")
        self.woken = set()                         # lanes that have fired in this micro-batch

    def handleInputRows(self, key, rows, timerValues):
        due = []
        for batch in rows:
            keys = batch[self.key].astype(object)
            fresh = set(zip(keys.where(keys.notna(), None), (batch[self.ts] + self.delay).tolist(), strict=True))
            self.pending.appendList(_entries(list(fresh)))
            due.append(min(t for _, t in fresh))
        if due:
            self._wake(min(due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Timers of several micro-batches may wake a lane together; the first fires all that is due.
        if tuple(key) in self.woken:
            return
        self.woken.add(tuple(key))
        watermark = timerValues.getCurrentWatermarkInMs()
        held = {d for entry in self.pending.get() for d in zip(*entry, strict=True)}
        rest = [d for d in held if d[1] > watermark]
        if len(rest) < len(held):
            self.pending.put(_entries(rest)) if rest else self.pending.clear()
            yield pd.DataFrame([d for d in held if d[1] <= watermark], columns=[self.key, "fire_ms"])
        if rest:
            self._wake(min(t for _, t in rest))

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(max(t, 0))

    def close(self) -> None:
        pass


class InOrder(StatefulProcessor):
    """Rows of a key in (ts, tie) order, once the watermark has passed them.

    ``fields`` maps each column a subclass reads to its SQL type; the time and
    the tie come first.  Subclasses give ``open`` (their state), ``walk`` (rows
    in order, as tuples of the fields; returns output rows) and ``next_due``
    (their own pending deadline, or ``_NO_TIMER``)."""

    def __init__(self, fields: dict[str, str]):
        self.fields = fields

    def init(self, handle) -> None:
        self.handle = handle
        schema = ", ".join(f"{name} array<{kind}>" for name, kind in self.fields.items())
        self.waiting = handle.getListState("waiting", schema)
        self.open()

    def open(self) -> None:
        pass

    def walk(self, key, rows: list[tuple], watermark: int) -> list[Row]:
        raise NotImplementedError

    def next_due(self) -> int:
        return _NO_TIMER

    def handleInputRows(self, key, rows, timerValues):
        fresh, take = [], None
        for r in rows:
            take = take or itemgetter(*[r.__fields__.index(f) for f in self.fields])
            fresh.append(take(r))
        if fresh:
            self.waiting.appendList(_entries(fresh))
            self._wake(min(_time(r) for r in fresh))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        held = [r for entry in self.waiting.get() for r in zip(*entry, strict=True)] if self.waiting.exists() else []
        ready = sorted((r for r in held if _time(r) <= watermark), key=lambda r: (_time(r), r[1] is not None, r[1]))
        rest = [r for r in held if _time(r) > watermark]
        if ready:
            self.waiting.put(_entries(rest)) if rest else self.waiting.clear()
        out = self.walk(key, ready, watermark)
        if rest:
            self._wake(min(map(_time, rest)))
        if (due := self.next_due()) != _NO_TIMER:
            self._wake(due)
        return iter(out)

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(max(t, 0))

    def close(self) -> None:
        pass


def _time(row: tuple) -> int:
    return _NO_TIME if row[0] is None else row[0]


def _entries(rows: list[tuple]) -> list[tuple]:
    """Rows as entries of a list state, an array for each field: what an entry
    costs on its way to the state store is paid once for many rows."""
    return [tuple(map(list, zip(*rows[at:at + _ENTRY_ROWS], strict=True))) for at in range(0, len(rows), _ENTRY_ROWS)]


def _held(state) -> tuple | None:
    """What a value state holds, by one call."""
    value = state.get()
    return None if value is None else tuple(value)


class CountChangelog(InOrder):
    """Each row retracts its key's count, when there is one, and adds
    the new one: (false, seq - 1) and (true, seq)."""

    def __init__(self, key: str, ts: str = "ts_ms", tie: str = "event_id"):
        super().__init__({ts: "long", tie: "long"})
        self.key = key

    def open(self) -> None:
        self.count = self.handle.getValueState("count", "n long")

    def walk(self, key, rows, watermark):
        n, out = (_held(self.count) or (0,))[0], []
        for _ in rows:
            n += 1
            if n > 1:
                out.append(Row(**{self.key: key[0], "seq": n, "is_add": False, "cnt": n - 1}))
            out.append(Row(**{self.key: key[0], "seq": n, "is_add": True, "cnt": n}))
        if rows:
            self.count.update((n,))
        return out


class TopValues(StatefulProcessor):
    """K6: the ``n`` largest values of a key, kept in state; a batch that
    brings rows of the key emits them anew with their ranks.  Order of rows
    does not matter."""

    def __init__(self, key: str, value: str, n: int = 2):
        self.key, self.value, self.n = key, value, n

    def init(self, handle) -> None:
        self.handle = handle
        self.top = handle.getListState("top", "v double")

    def handleInputRows(self, key, rows, timerValues):
        held = [r[0] for r in self.top.get()] if self.top.exists() else []
        held += [r[self.value] for r in rows]
        # Nulls rank last, as in a descending sort.
        held = sorted(held, key=lambda v: (v is None, -(v or 0.0)))[:self.n]
        self.top.put([(v,) for v in held])
        return iter([Row(**{self.key: key[0], self.value: v, "rank": i + 1}) for i, v in enumerate(held)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter(())

    def close(self) -> None:
        pass


class RisingAlert(InOrder):
    """Alert when the value has kept rising (no drop) for ``delay_ms``."""

    def __init__(self, key: str, value: str, delay_ms: int, ts: str = "ts_ms", tie: str = "event_id"):
        super().__init__({ts: "long", tie: "long", value: "double"})
        self.key, self.delay = key, delay_ms

    def open(self) -> None:
        self.last = self.handle.getValueState("last", "v double, seen boolean")
        self.due = self.handle.getValueState("due", "t long")

    def next_due(self) -> int:
        return (_held(self.due) or (_NO_TIMER,))[0]

    def walk(self, key, rows, watermark):
        out, due = [], self.next_due()
        last, seen = _held(self.last) or (None, False)
        for ts, _, value in rows:
            if due != _NO_TIMER and ts is not None and ts > due:
                out.append(Row(**{self.key: key[0], "alert_ms": due}))
                due = _NO_TIMER
            if last is None or (value is not None and value < last):
                due = _NO_TIMER
            elif value is not None and value > last and due == _NO_TIMER and ts is not None:
                due = ts + self.delay
            last, seen = value, True
        if due != _NO_TIMER and due <= watermark:
            out.append(Row(**{self.key: key[0], "alert_ms": due}))
            due = _NO_TIMER
        if rows:
            self.last.update((last, seen))
        self.due.clear() if due == _NO_TIMER else self.due.update((due,))
        return out


class ListStateRounds(InOrder):
    """I4: count rows forever; the first row while no timer is pending sets one
    at ts + period; a firing emits the count stored so far."""

    def __init__(self, key: str, period_ms: int, ts: str = "ts_ms", tie: str = "event_id"):
        super().__init__({ts: "long", tie: "long"})
        self.key, self.period = key, period_ms

    def open(self) -> None:
        self.count = self.handle.getValueState("count", "n long")
        self.due = self.handle.getValueState("due", "t long")

    def next_due(self) -> int:
        return (_held(self.due) or (_NO_TIMER,))[0]

    def walk(self, key, rows, watermark):
        out, due = [], self.next_due()
        n = (_held(self.count) or (0,))[0]
        for ts, _ in rows:
            if due != _NO_TIMER and ts is not None and ts > due:
                out.append(Row(**{self.key: key[0], "fire_ms": due, "cnt": n}))
                due = _NO_TIMER
            n += 1
            if due == _NO_TIMER and ts is not None:
                due = ts + self.period
        if due != _NO_TIMER and due <= watermark:
            out.append(Row(**{self.key: key[0], "fire_ms": due, "cnt": n}))
            due = _NO_TIMER
        if rows:
            self.count.update((n,))
        self.due.clear() if due == _NO_TIMER else self.due.update((due,))
        return out


class PendingCreates(InOrder):
    """A create waits ``within_ms`` for a later payment of its key
    (inclusive deadline); a payment settles every create up to ``within_ms``
    before it.  Pending creates stand in order of their time, so deadlines
    pass and payments settle from the front."""

    def __init__(self, key: str, within_ms: int, ts: str = "ts_ms", tie: str = "event_id",
                 type_col: str = "event_type", create: str = "create"):
        super().__init__({ts: "long", tie: "long", type_col: "string"})
        self.key, self.within, self.create = key, within_ms, create

    def open(self) -> None:
        self.pending = self.handle.getListState("pending", "event_id long, ts_ms long")

    def next_due(self) -> int:
        first = next(iter(self.pending.get()), None) if self.pending.exists() else None
        return _NO_TIMER if first is None else tuple(first)[1] + self.within

    def _timeout(self, key, item):
        return Row(**{self.key: key[0], "event_id": item[0], "ts_ms": item[1], "deadline_ms": item[1] + self.within})

    def walk(self, key, rows, watermark):
        pending, out = deque(tuple(p) for p in self.pending.get()) if self.pending.exists() else deque(), []
        for ts, event_id, kind in rows:
            if ts is None:
                continue
            while pending and pending[0][1] + self.within < ts:      # deadline passed before this row
                out.append(self._timeout(key, pending.popleft()))
            if kind == self.create:
                pending.append((event_id, ts))
            elif key[0] is not None:                                 # null keys match nothing
                while pending and pending[0][1] < ts:                # settled by this payment
                    pending.popleft()
        while pending and pending[0][1] + self.within <= watermark:
            out.append(self._timeout(key, pending.popleft()))
        self.pending.put(list(pending)) if pending else self.pending.clear()
        return out


class ConsecutiveFails(InOrder):
    """H1: three consecutive events of a key, all matching, within the limit.
    State: the key's last two events."""

    def __init__(self, key: str, kind_col: str, kind: str, within_ms: int, ip: str = "ip_addr",
                 ts: str = "ts_ms", tie: str = "event_id"):
        super().__init__({ts: "long", tie: "long", kind_col: "string", ip: "string"})
        self.key, self.kind, self.within = key, kind, within_ms

    def open(self) -> None:
        self.recent = self.handle.getListState("recent", "ts_ms long, is_kind boolean, ip string")

    def walk(self, key, rows, watermark):
        recent = [tuple(x) for x in self.recent.get()] if self.recent.exists() else []
        out = []
        for ts, _, kind, ip in rows:
            recent = (recent + [(ts, kind == self.kind, ip)])[-3:]
            if (len(recent) == 3 and all(x[1] and x[0] is not None for x in recent)
                    and recent[2][0] - recent[0][0] < self.within):
                out.append(Row(**{self.key: key[0], "first_ts": recent[0][0], "ip1": recent[0][2],
                                  "ip2": recent[1][2], "ip3": recent[2][2]}))
        if rows:
            self.recent.put(recent[-2:])
        return out


class FollowedBy(InOrder):
    """H2: a ``first`` event immediately followed by a ``second`` event of the
    same key within ``within_ms`` (exclusive).  A pending ``first`` times out
    when the key's next event is not earlier than its deadline (inline) or
    when the watermark passes the deadline; a next event in time but of
    another type discards it.  Emits ``kind`` = match (two rows) / timeout."""

    def __init__(self, key: str, type_col: str, first: str, second: str, within_ms: int,
                 ts: str = "ts_ms", tie: str = "event_id"):
        super().__init__({ts: "long", tie: "long", type_col: "string"})
        self.key, self.first, self.second, self.within = key, first, second, within_ms

    def open(self) -> None:
        self.pending = self.handle.getValueState("pending", "ts_ms long, event_id long, event_type string")

    def next_due(self) -> int:
        p = _held(self.pending)
        return _NO_TIMER if p is None else p[0] + self.within

    def _row(self, key, kind, match_id, item):
        return Row(**{"kind": kind, self.key: key[0], "match_id": match_id, "event_id": item[1],
                      "event_type": item[2], "ts_ms": item[0], "deadline_ms": item[0] + self.within})

    def walk(self, key, rows, watermark):
        out, p = [], _held(self.pending)
        for item in rows:
            if p is not None:
                if item[0] - p[0] >= self.within:
                    out.append(self._row(key, "timeout", p[1], p))
                elif item[2] == self.second:
                    out += [self._row(key, "match", p[1], p), self._row(key, "match", p[1], item)]
                p = None
            if item[2] == self.first and item[0] is not None:
                p = item
        if p is not None and p[0] + self.within <= watermark:
            out.append(self._row(key, "timeout", p[1], p))
            p = None
        self.pending.clear() if p is None else self.pending.update(p)
        return out


class SwitchGate(InOrder):
    """Forward a key's readings while one of its switches is on.  A
    switch row opens ``[ts, ts + dur)``.  Rows come in order, so only the
    latest end of the open switches matters."""

    def __init__(self, key: str, is_switch: str = "is_switch", dur: str = "dur_ms", ts: str = "ts_ms", tie: str = "event_id",
                 out_cols=("event_id", "user_id", "ts_ms", "temperature"),
                 out_types=("long", "long", "long", "double")):
        super().__init__({ts: "long", tie: "long", is_switch: "boolean", dur: "long",
                          **{c: t for c, t in zip(out_cols, out_types, strict=True) if c not in (ts, tie, key)}})
        self.key, self.ts, self.out_cols = key, ts, list(out_cols)

    def open(self) -> None:
        self.until = self.handle.getValueState("until", "end long")

    def walk(self, key, rows, watermark):
        names, out = list(self.fields), []
        until = (_held(self.until) or (_NO_TIME,))[0]
        # A switch counts for every reading at its own time, whatever their ids.
        opening = [(r[0], r[0] + r[3]) for r in rows if r[2] and r[0] is not None and r[3] is not None]
        ends, top = [], until
        for _, end in opening:
            top = max(top, end)
            ends.append(top)
        starts = [s for s, _ in opening]
        for r in rows:
            if not r[2] and r[0] is not None:
                k = bisect_right(starts, r[0])
                if r[0] < (ends[k - 1] if k else until):
                    row = dict(zip(names, r, strict=True)) | {self.key: key[0]}
                    out.append(Row(**{c: row[c] for c in self.out_cols}))
        if top > watermark:
            self.until.update((top,))
        else:
            self.until.clear()
        return out


class ProcessingTimeDeadline(StatefulProcessor):
    """A processing-time timer ``delay_ms`` after a key's rows are
    processed; each firing emits (key, fire_ms).  Clock dependent by nature,
    so it runs only on streams (``timeMode="ProcessingTime"``)."""

    def __init__(self, key: str, delay_ms: int):
        self.key, self.delay = key, delay_ms

    def init(self, handle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield Row(**{self.key: key[0], "fire_ms": expiredTimerInfo.getExpiryTimeInMs()})

    def close(self) -> None:
        pass

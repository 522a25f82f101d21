"""Windows kept in state by ``transformWithState``.

A key of these processors is a window (and a group), so its state ends with
the window.  Rows are counted before the shuffle: ``partial_counts`` turns
each Arrow batch into one row per group, window and step, so a hot group sends
some rows a task instead of all of its own.  The event-time column does not
travel with the counts, so the engine drops none of them: what is late is the
processor's own decision, by the watermark of the micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventide.functions.time import floor_div


def partial_counts(rows: DataFrame, key: str, ts_ms: str, size_ms: int, step_ms: int | None = None) -> DataFrame:
    """(key, window_start, step, n): rows of each step of each tumbling
    window, counted inside every Arrow batch.  Rows without a time have no
    window and are left out."""
    step = step_ms or size_ms
    start = floor_div(F.col(ts_ms), size_ms) * size_ms
    x = (rows.filter(F.col(ts_ms).isNotNull()).select(key, start.cast("long").alias("window_start"), ts_ms)
         .select(key, "window_start", floor_div(F.col(ts_ms) - F.col("window_start"), step).cast("long").alias("step")))
    names = [key, "window_start", "step"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")])
            yield from found.select([*names, "count_all"]).rename_columns([*names, "n"]).to_batches()

    kind = rows.schema[key].dataType.simpleString()
    return x.mapInArrow(count, f"{key} {kind}, window_start long, step long, n long")


def _watermark(timerValues) -> int | None:
    """The micro-batch's watermark; none before the first one."""
    wm = timerValues.getCurrentWatermarkInMs()
    return wm if wm > 0 else None


class LateCounts(StatefulProcessor):
    """the count of one (key, window) with allowed lateness.

    Rows that come while the watermark is below ``close = window_end - 1`` are
    on time.  The first emission (seq 1) is due at ``close``; each row after
    that, until ``close + lateness``, emits the updated count with the next
    number; later rows are dropped.  Two timers wake the window: one at
    ``close``, one at ``close + lateness``, which ends its state.
    """

    def __init__(self, key: str, size_ms: int, lateness_ms: int):
        self.key, self.size, self.lateness = key, size_ms, lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "cnt long, seq long")

    def _row(self, key, cnt: int, seq: int) -> Row:
        return Row(**{self.key: key[0], "window_end": key[1] + self.size, "seq": seq, "cnt": cnt, "is_update": seq > 1})

    def _held(self) -> tuple[int, int]:
        return tuple(self.window.get()) if self.window.exists() else (0, 0)

    def handleInputRows(self, key, rows, timerValues):
        close, wm = key[1] + self.size - 1, _watermark(timerValues)
        n = sum(r["n"] for r in rows)
        if wm is not None and wm >= close + self.lateness:
            return
        cnt, seq = self._held()
        if wm is None or wm < close:
            cnt += n
            self.handle.registerTimer(close)
        else:
            if cnt and not seq:                    # the window closed, its timer is still to come
                seq = 1
                yield self._row(key, cnt, seq)
            for _ in range(n):
                cnt, seq = cnt + 1, seq + 1
                yield self._row(key, cnt, seq)
        self.handle.registerTimer(close + self.lateness)
        self.window.update((cnt, seq))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        cnt, seq = self._held()
        if cnt and not seq:
            seq = 1
            self.window.update((cnt, seq))
            yield self._row(key, cnt, seq)
        if timerValues.getCurrentWatermarkInMs() >= key[1] + self.size - 1 + self.lateness:
            self.window.clear()

    def close(self) -> None:
        pass


class CumulativeCounts(StatefulProcessor):
    """The running count of one (key, window), fired at every step end.

    One timer renews itself: it fires at a step end T with the count of the
    rows before T, is set again at T + step, and stops at the window's end,
    where the state goes too.  Steps that one watermark passes together fire
    together, each with its own count.
    """

    def __init__(self, key: str, size_ms: int, step_ms: int):
        if step_ms <= 0 or size_ms % step_ms:
            raise ValueError(f"the window of {size_ms} ms is not a multiple of the step of {step_ms} ms")
        self.key, self.size, self.step = key, size_ms, step_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "step long", "n long")     # steps that have not fired
        self.fired = handle.getValueState("fired", "next long, cnt long")       # next step end, count before it

    def handleInputRows(self, key, rows, timerValues):
        added: dict[int, int] = {}
        for r in rows:
            added[r["step"]] = added.get(r["step"], 0) + r["n"]
        for step, n in added.items():
            held = self.waiting.getValue((step,))[0] if self.waiting.containsKey((step,)) else 0
            self.waiting.updateValue((step,), (held + n,))
        first = min(added) + 1
        due, cnt = tuple(self.fired.get()) if self.fired.exists() else (first, 0)
        due = min(due, first) if cnt == 0 else due
        self.fired.update((due, cnt))
        self.handle.registerTimer(key[1] + due * self.step)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.fired.exists():
            return
        due, cnt = tuple(self.fired.get())
        wm, last = timerValues.getCurrentWatermarkInMs(), self.size // self.step
        held = {k[0]: v[0] for k, v in self.waiting.iterator()}
        while due <= last and key[1] + due * self.step <= wm:
            cnt += sum(held.pop(s) for s in [s for s in held if s < due])
            yield Row(**{self.key: key[0], "window_end": key[1] + self.size, "fire_ms": key[1] + due * self.step, "cnt": cnt})
            due += 1
        if due > last:
            self.waiting.clear()
            self.fired.clear()
            return
        for k in [k for k, _ in self.waiting.iterator()]:
            if k[0] not in held:
                self.waiting.removeKey(k)
        self.fired.update((due, cnt))
        self.handle.registerTimer(key[1] + due * self.step)

    def close(self) -> None:
        pass


class WatermarkSeen(StatefulProcessor):
    """C4: every row with the watermark of its micro-batch (null before the
    first one).  Any key does: the watermark is the stream's."""

    def __init__(self, columns: tuple[str, ...]):
        self.columns = columns

    def init(self, handle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        wm = _watermark(timerValues)
        for r in rows:
            yield Row(**{c: r[c] for c in self.columns}, wm_ms=wm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return iter(())

    def close(self) -> None:
        pass


class TopOfWindow(StatefulProcessor):
    """The ``n`` highest counts of one window, in list state, ranked
    when a timer passes the window's end.  Counts of a window may come over
    several micro-batches; the list never holds more than ``n``."""

    def __init__(self, n: int, item: str, item_type: str, after_ms: int = 1):
        self.n, self.item, self.item_type, self.after = n, item, item_type, after_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.top = handle.getListState("top", f"item {self.item_type}, cnt long")

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(x) for x in self.top.get()] if self.top.exists() else []
        for r in rows:
            held.append((r[self.item], r["cnt"]))
            if len(held) > 1000 + self.n:
                held = self._best(held)
        self.top.put(self._best(held))
        self.handle.registerTimer(key[0] + self.after)
        return iter(())

    def _best(self, held):
        return sorted(held, key=lambda x: (-x[1], x[0] is not None, x[0]))[:self.n]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for i, (item, cnt) in enumerate(tuple(x) for x in self.top.get()):
            yield Row(**{"window_end": key[0], "rank": i + 1, self.item: item, "cnt": cnt})
        self.top.clear()

    def close(self) -> None:
        pass


def lane_of(key: str, lanes: int):
    """The lane of a key: one of ``lanes`` groups of keys."""
    return F.pmod(F.xxhash64(key), F.lit(lanes))


class ArrivalTimers(StatefulProcessor):
    """A processing-time timer ``delay_ms`` after each arrival of a key
    (one micro-batch is one arrival).  Each firing emits how long it waited by
    its own time, which does not depend on the clock.

    Grouped by ``lane_of`` the key: keys of a lane that arrive together have
    the same due time, so they share a timer and a state entry."""

    def __init__(self, key: str, delay_ms: int, key_type: str = "string"):
        self.key, self.delay, self.key_type = key, delay_ms, key_type

    def init(self, handle) -> None:
        self.handle = handle
        self.arrivals = handle.getMapState("arrivals", "fire_ms long", f"arrival_ms long, keys array<{self.key_type}>")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        due, arrived = (now + self.delay,), {r[self.key] for r in rows}
        held = self.arrivals.getValue(due)
        if held is not None:
            arrived |= set(held[1])
        self.arrivals.updateValue(due, (now, list(arrived)))
        self.handle.registerTimer(now + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at = expiredTimerInfo.getExpiryTimeInMs()
        arrival, arrived = self.arrivals.getValue((at,))
        self.arrivals.removeKey((at,))
        for k in arrived:
            yield Row(**{self.key: k, "waited_ms": at - arrival})

    def close(self) -> None:
        pass

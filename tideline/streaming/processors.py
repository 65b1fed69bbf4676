"""Keyed stateful stream operators on ``transformWithState``.

These are the streaming forms of :mod:`tideline.operators.keyed`: Spark
routes each key to one task, keeps its state in the (RocksDB) state store,
checkpoints it with the query and restores it after a failure or restart.
Within a micro-batch a key's rows are processed in ``seq`` order (Spark does
not promise arrival order inside a batch, the sort restores it; the rows of
one key in one batch are bounded by the trigger's input limit).

Use::

    df.groupBy("id").transformWithState(LevelJumpAlert(), LevelJumpAlert.SCHEMA,
                                        "Append", "None")

or the :func:`apply` helper, which picks the time mode.
"""

from __future__ import annotations

import bisect
from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                       StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField, StructType,
                               DoubleType)


def _sorted(rows: Iterator[Row], order: str = "seq") -> list[Row]:
    return sorted(rows, key=lambda r: (r[order] is None, r[order]))


class LevelJumpAlert(StatefulProcessor):
    """ValueState ``lastVc`` (0 when absent or expired): emit when
    ``|vc - lastVc| > threshold``, then store vc. With ``ttl_ms`` the state
    expires ``ttl_ms`` after its last write (processing time)."""

    SCHEMA = StructType([StructField("id", StringType()), StructField("ts", LongType()),
                         StructField("vc", IntegerType()), StructField("seq", LongType()),
                         StructField("last_vc", IntegerType())])

    def __init__(self, threshold: int = 10, ttl_ms: int | None = None):
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_vc", "vc int", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in _sorted(rows):
            if r.vc is None:
                continue
            last = self.last.get()[0] if self.last.exists() else 0
            if abs(r.vc - last) > self.threshold:
                yield Row(id=r.id, ts=r.ts, vc=r.vc, seq=r.seq, last_vc=last)
            self.last.update((r.vc,))

    def close(self) -> None:
        pass


class RunningTopK(StatefulProcessor):
    """ListState of the k largest values so far; the list after every row."""

    def __init__(self, k: int = 3):
        self.k = k
        self.SCHEMA = StructType([StructField("id", StringType()), StructField("seq", LongType()),
                                  StructField("vc", IntegerType()),
                                  StructField(f"top{k}", ArrayType(IntegerType()))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", "vc int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cur = [t[0] for t in self.top.get()] if self.top.exists() else []
        for r in _sorted(rows):
            if r.vc is None:
                continue
            cur = sorted(cur + [r.vc], reverse=True)[: self.k]
            yield Row(id=r.id, seq=r.seq, vc=r.vc, **{f"top{self.k}": list(cur)})
        self.top.put([(v,) for v in cur])

    def close(self) -> None:
        pass


class RunningHistogram(StatefulProcessor):
    """MapState vc -> count; after every row the entry it changed."""

    SCHEMA = StructType([StructField("id", StringType()), StructField("seq", LongType()),
                         StructField("vc", IntegerType()), StructField("cnt", LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "vc int", "cnt bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in _sorted(rows):
            if r.vc is None:
                continue
            k = (r.vc,)
            n = (self.counts.getValue(k)[0] if self.counts.containsKey(k) else 0) + 1
            self.counts.updateValue(k, (n,))
            yield Row(id=r.id, seq=r.seq, vc=r.vc, cnt=n)

    def close(self) -> None:
        pass


class RunningAggregate(StatefulProcessor):
    """ReducingState (sum) / AggregatingState (sum, count -> avg): the value
    after every row."""

    SCHEMA = StructType([StructField("id", StringType()), StructField("seq", LongType()),
                         StructField("vc", IntegerType()), StructField("vc_sum", LongType()),
                         StructField("vc_avg", DoubleType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "s bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s, n = self.acc.get() if self.acc.exists() else (None, 0)
        for r in _sorted(rows):
            if r.vc is not None:
                s, n = (r.vc if s is None else s + r.vc), n + 1
            yield Row(id=r.id, seq=r.seq, vc=r.vc, vc_sum=s, vc_avg=(s / n) if n else None)
        self.acc.update((s, n))

    def close(self) -> None:
        pass


class GroupSumChangelog(StatefulProcessor):
    """``sum(vc) group by id`` as a changelog: +I first, then -U/+U pairs."""

    SCHEMA = StructType([StructField("id", StringType()), StructField("seq", LongType()),
                         StructField("op_no", IntegerType()), StructField("op", StringType()),
                         StructField("sumVc", LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "s bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.total.exists()
        old = self.total.get()[0] if seen else None
        for r in _sorted(rows):
            new = old if r.vc is None else (r.vc if old is None else old + r.vc)
            if not seen:
                yield Row(id=r.id, seq=r.seq, op_no=0, op="+I", sumVc=new)
                seen = True
            elif new != old:
                yield Row(id=r.id, seq=r.seq, op_no=0, op="-U", sumVc=old)
                yield Row(id=r.id, seq=r.seq, op_no=1, op="+U", sumVc=new)
            old = new
        self.total.update((old,))

    def close(self) -> None:
        pass


class KeyTimer(StatefulProcessor):
    """Per key, each row registers a timer; the timer fires once for all
    registrations at the same time.

    ``fixed_ms``: the reference's fixed event-time timer (5000 ms). Both
    engines fire when the watermark reaches T, but the reference's watermark
    trails the maximum event time by one extra millisecond, so the timer is
    registered at ``T + 1`` to fire after the same row. ``delay_ms`` instead
    registers ``now + delay`` in processing time
    (``timeMode="ProcessingTime"``).
    """

    SCHEMA = StructType([StructField("id", StringType()), StructField("timer_ms", LongType()),
                         StructField("watermark_ms", LongType())])

    def __init__(self, fixed_ms: int | None = 5000, delay_ms: int | None = None):
        self.fixed_ms, self.delay_ms = fixed_ms, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        for _ in rows:
            if self.delay_ms is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
            else:
                self.handle.registerTimer(self.fixed_ms + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        fired = t - 1 if self.delay_ms is None else t
        yield Row(id=key[0], timer_ms=fired, watermark_ms=timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def apply(df: DataFrame, processor: StatefulProcessor, key: str = "id", time_mode: str = "None",
          output_mode: str = "Append") -> DataFrame:
    """``groupBy(key).transformWithState(processor, processor.SCHEMA, ...)``."""
    return df.groupBy(key).transformWithState(processor, processor.SCHEMA, output_mode, time_mode)


class AllowedLateness(StatefulProcessor):
    """Tumbling event-time windows with allowed lateness and a late side
    output, per key.

    Output rows: ``kind = 'firing'`` -- one per window firing (``firing`` 0 when
    the watermark passes the window end, k for the k-th allowed-late row, each
    with the full count/sum so far); ``kind = 'late'`` -- a row whose window
    was already past ``end + lateness`` (the side output).

    The reference's watermark is ``max ts - delay``. The input must carry
    Spark's watermark with delay ``delay + lateness + size`` (see
    :func:`allowed_lateness_stream`) so Spark keeps every row that may still
    count; the processor adds ``lateness + size`` back to get the reference's
    watermark. Classification uses the watermark of the micro-batch (Spark
    moves it between batches, not per record).
    """

    SCHEMA = StructType([StructField("kind", StringType()), StructField("id", StringType()),
                         StructField("window_start", LongType()), StructField("window_end", LongType()),
                         StructField("firing", LongType()), StructField("cnt", LongType()),
                         StructField("vc", LongType()), StructField("ts", LongType()),
                         StructField("seq", LongType())])

    def __init__(self, size_s: int = 10, delay_s: int = 3, lateness_s: int = 2):
        self.size, self.delay, self.lateness = size_s, delay_s, lateness_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint",
                                          "cnt bigint, vc bigint, fired boolean, allowed bigint")

    def _wm(self, timerValues) -> int | None:
        spark_wm = timerValues.getCurrentWatermarkInMs()
        if spark_wm <= 0:
            return None  # no watermark yet
        return spark_wm // 1000 + self.lateness + self.size

    def _row(self, kind, key, start, firing=None, cnt=None, vc=None, ts=None, seq=None):
        return Row(kind=kind, id=key, window_start=start, window_end=start + self.size, firing=firing,
                   cnt=cnt, vc=vc, ts=ts, seq=seq)

    def _close(self, key, wm) -> Iterator[Row]:
        """Fire windows the watermark has passed; drop those past lateness."""
        if wm is None:
            return
        for (start,), (cnt, vc, fired, allowed) in list(self.windows.iterator()):
            end = start + self.size
            if not fired and end <= wm:
                if cnt:
                    yield self._row("firing", key, start, 0, cnt, vc)
                self.windows.updateValue((start,), (cnt, vc, True, allowed))
            if end + self.lateness <= wm:
                self.windows.removeKey((start,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = self._wm(timerValues)
        yield from self._close(key[0], wm)
        for r in _sorted(rows):
            start = r.ts - r.ts % self.size
            end = start + self.size
            if wm is not None and end + self.lateness <= wm:
                yield self._row("late", key[0], start, ts=r.ts, seq=r.seq, vc=r.vc)
                continue
            k = (start,)
            cnt, vc, fired, allowed = self.windows.getValue(k) if self.windows.containsKey(k) else (0, None, False, 0)
            vc = r.vc if vc is None else (vc if r.vc is None else vc + r.vc)
            if not self.windows.containsKey(k):  # whichever row opens a window also sees to its end
                self.handle.registerTimer((end - self.size) * 1000)
            if wm is not None and end <= wm:          # closed: allowed-late row re-fires the window
                allowed += 1
                self.windows.updateValue(k, (cnt, vc, True, allowed))
                yield self._row("firing", key[0], start, allowed, cnt + allowed, vc)
            else:                                     # on time
                if not self.windows.containsKey(k):
                    self.handle.registerTimer((end - self.lateness - self.size) * 1000)
                self.windows.updateValue(k, (cnt + 1, vc, fired, allowed))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._close(key[0], self._wm(timerValues))

    def close(self) -> None:
        pass


def allowed_lateness_stream(df: DataFrame, size_s: int = 10, delay_s: int = 3, lateness_s: int = 2,
                            key: str = "id") -> DataFrame:
    """Streaming allowed lateness: firings and late rows (``kind`` column)."""
    from ..operators.windows import with_watermark

    w = with_watermark(df, delay_s + lateness_s + size_s)
    return w.groupBy(key).transformWithState(AllowedLateness(size_s, delay_s, lateness_s),
                                             AllowedLateness.SCHEMA, "Append", "EventTime")


class OverRangeCount(StatefulProcessor):
    """``count(vc) over (partition by id order by ts range between R preceding
    and current row)`` on a stream (Spark rejects non-time windows there).

    Rows wait per key until the watermark passes their ``ts`` -- then every
    row of that ``ts`` has arrived -- and are emitted in ``ts`` order with the
    count over ``[ts - R, ts]``. Of emitted rows only the number of values per
    ``ts`` is kept, as long as it can fall in a later frame. A key has one
    pending timer: its next row's ``ts``, or the end of what it keeps, so state
    is read once per step of the watermark and a silent key's state goes.
    """

    SCHEMA = StructType([StructField("id", StringType()), StructField("ts", LongType()),
                         StructField("vc", IntegerType()), StructField("seq", LongType()),
                         StructField("cnt", LongType())])

    def __init__(self, range_s: int = 10):
        self.range = range_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts bigint, seq bigint", "vc int")
        self.values = handle.getMapState("values", "ts bigint", "n bigint")
        self.timer = handle.getValueState("timer", "at bigint")

    def _set_timer(self, at: int | None) -> None:
        """Move the key's only timer."""
        if self.timer.exists():
            if at == (old := self.timer.get()[0]):
                return
            self.handle.deleteTimer(old)
            self.timer.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _step(self, key, wm: int) -> Iterator[Row]:
        """Emit what the watermark (seconds) has passed and set the next timer."""
        rows = sorted((ts, seq, vc) for (ts, seq), (vc,) in self.waiting.iterator())
        ready = [r for r in rows if r[0] <= wm]
        kept = {ts: n for (ts,), (n,) in self.values.iterator()}
        for ts, _, vc in ready:
            if vc is not None:
                kept[ts] = kept.get(ts, 0) + 1
        stamps = sorted(kept)
        sums = [0]
        for ts in stamps:
            sums.append(sums[-1] + kept[ts])
        for ts, seq, vc in ready:
            cnt = sums[bisect.bisect_right(stamps, ts)] - sums[bisect.bisect_left(stamps, ts - self.range)]
            yield Row(id=key, ts=ts, vc=vc, seq=seq, cnt=cnt)
            self.waiting.removeKey((ts, seq))
        for ts in stamps:
            if ts < wm - self.range:
                if self.values.containsKey((ts,)):
                    self.values.removeKey((ts,))
            else:
                self.values.updateValue((ts,), (kept[ts],))
        later = [r[0] for r in rows if r[0] > wm]
        left = [ts for ts in stamps if ts >= wm - self.range]
        self._set_timer(later[0] * 1000 if later else (left[-1] + self.range + 1) * 1000 if left else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        for r in rows:
            self.waiting.updateValue((r.ts, r.seq), (r.vc,))
            first = r.ts if first is None else min(first, r.ts)
        wm_ms = timerValues.getCurrentWatermarkInMs()
        if wm_ms > 0 and first is not None and first <= wm_ms // 1000:
            yield from self._step(key[0], wm_ms // 1000)
        elif first is not None and (not self.timer.exists() or first * 1000 < self.timer.get()[0]):
            self._set_timer(first * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        yield from self._step(key[0], timerValues.getCurrentWatermarkInMs() // 1000)

    def close(self) -> None:
        pass


class RunningCount(StatefulProcessor):
    """Keyed running count emitted for **every** input row (``keyBy(word).sum(1)``
    on a stream); Spark's own ``groupBy().count()`` in update mode emits one
    row per key per micro-batch instead. Rows of a key inside a batch are
    counted in ``order`` order."""

    def __init__(self, key: str, order: tuple, columns: StructType):
        self.key, self.order = key, tuple(order)
        self.SCHEMA = StructType(list(columns.fields) + [StructField("cnt", LongType())])
        self.names = [f.name for f in columns.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else 0
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            n += 1
            yield Row(**{c: r[c] for c in self.names}, cnt=n)
        self.count.update((n,))

    def close(self) -> None:
        pass

"""Window operators on streams that Spark has no built-in form for: Top-N per
window end, fired by a timer, and count windows."""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                       StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import DataType, LongType, StructField, StructType

from ..operators.topn import sliding_count


class TopNPerWindow(StatefulProcessor):
    """The ``n`` values with most rows of one window end.

    Counts of a window may come in several micro-batches. State holds the n
    best of them so far (ties: smaller value first, null before all), and an
    event-time timer one millisecond after the window's end gives them out and
    drops them, so no window's whole list is ever gathered.
    """

    def __init__(self, n: int, value: str, value_type: DataType):
        self.n, self.value = n, value
        self.type = value_type.simpleString()
        self.SCHEMA = StructType([StructField("window_start", LongType()), StructField("window_end", LongType()),
                                  StructField("rank", LongType()), StructField(value, value_type),
                                  StructField("cnt", LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"start bigint, v {self.type}, cnt bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        best = list(self.best.get()) if self.best.exists() else []
        if not best:
            self.handle.registerTimer(key[0] * 1000 + 1)
        fresh = ((r.window_start, r[self.value], r.cnt) for r in rows)
        order = lambda x: (-x[2], x[1] is not None, x[1])
        for x in fresh:
            if len(best) < self.n or order(x) < order(best[-1]):
                best = sorted([*(tuple(b) for b in best), x], key=order)[: self.n]
        self.best.put(best)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        for rank, (start, v, cnt) in enumerate(list(self.best.get()), 1):
            yield Row(**{"window_start": start, "window_end": key[0], "rank": rank, self.value: v, "cnt": cnt})
        self.best.clear()

    def close(self) -> None:
        pass


def topn_of_counts(counts: DataFrame, n: int = 2, value: str = "vc") -> DataFrame:
    """Top-N per window end of a watermarked stream of ``window_start,
    window_end, <value>, cnt`` rows, at the first watermark past each end."""
    proc = TopNPerWindow(n, value, counts.schema[value].dataType)
    return counts.select("window_start", "window_end", value, "cnt").groupBy("window_end").transformWithState(
        proc, proc.SCHEMA, "Append", "EventTime")


def sliding_topn_stream(df: DataFrame, size_s: int = 10, slide_s: int = 5, n: int = 2, value: str = "vc") -> DataFrame:
    """:func:`~tideline.operators.topn.sliding_topn` on a watermarked stream:
    a windowed count in append mode, and behind it a second stateful operator
    keyed by window end with a timer."""
    return topn_of_counts(sliding_count(df, size_s, slide_s, value), n, value)


class CountWindow(StatefulProcessor):
    """Tumbling count window: after every ``size``-th row of a key its number
    (from 0), sum and last ``ts``. State is one accumulator per key."""

    SCHEMA_TAIL = [StructField("window_no", LongType()), StructField("cnt", LongType()),
                   StructField("vc", LongType()), StructField("ts", LongType())]

    def __init__(self, size: int, key: str, key_type: DataType):
        self.size, self.key = size, key
        self.SCHEMA = StructType([StructField(key, key_type), *self.SCHEMA_TAIL])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "n bigint, vc bigint, ts bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        n, vc, ts = self.acc.get() if self.acc.exists() else (0, None, None)
        for r in sorted(rows, key=lambda r: (r.seq is not None, r.seq or 0)):
            n += 1
            vc = vc if r.vc is None else r.vc if vc is None else vc + r.vc
            ts = r.ts  # the ts of the last row, null or not
            if n % self.size == 0:
                yield Row(**{self.key: key[0], "window_no": n // self.size - 1, "cnt": self.size, "vc": vc, "ts": ts})
                vc = ts = None
        self.acc.update((n, vc, ts))

    def close(self) -> None:
        pass


class SlidingCountWindow(StatefulProcessor):
    """Sliding count window: after every ``slide``-th row of a key the count
    and sum of its last (up to) ``size`` rows.

    State is a ring: the value at position ``row number modulo size`` and the
    row number. A micro-batch reads the ring once and writes the places that
    it has changed, so no list is rewritten per row.
    """

    SCHEMA_TAIL = [StructField("fire_rn", LongType()), StructField("cnt", LongType()), StructField("vc", LongType())]

    def __init__(self, size: int, slide: int, key: str, key_type: DataType):
        self.size, self.slide, self.key = size, slide, key
        self.SCHEMA = StructType([StructField(key, key_type), *self.SCHEMA_TAIL])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getMapState("ring", "place int", "vc bigint")
        self.rn = handle.getValueState("rn", "n bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        n = self.rn.get()[0] if self.rn.exists() else 0
        ring = {place: vc for (place,), (vc,) in self.ring.iterator()}
        changed = set()
        for r in sorted(rows, key=lambda r: (r.seq is not None, r.seq or 0)):
            place = n % self.size
            ring[place] = r.vc
            changed.add(place)
            n += 1
            if n % self.slide == 0:
                values = [v for v in ring.values() if v is not None]
                yield Row(**{self.key: key[0], "fire_rn": n, "cnt": len(ring), "vc": sum(values) if values else None})
        for place in changed:
            self.ring.updateValue((place,), (ring[place],))
        self.rn.update((n,))

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, size: int = 5, key: str = "id") -> DataFrame:
    """:func:`~tideline.operators.windows.count_window` on a stream of ``ts,
    vc, seq`` rows: rows of a micro-batch in ``seq`` order, batches in turn."""
    proc = CountWindow(size, key, df.schema[key].dataType)
    return df.select(key, "ts", "vc", "seq").groupBy(key).transformWithState(proc, proc.SCHEMA, "Append", "None")


def count_window_sliding_stream(df: DataFrame, size: int = 5, slide: int = 2, key: str = "id") -> DataFrame:
    """:func:`~tideline.operators.windows.count_window_sliding` on a stream."""
    proc = SlidingCountWindow(size, slide, key, df.schema[key].dataType)
    return df.select(key, "vc", "seq").groupBy(key).transformWithState(proc, proc.SCHEMA, "Append", "None")

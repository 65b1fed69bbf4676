"""Two-input stream operators on ``transformWithState``: the interval join with
its late rows, and the broadcast threshold with replicated state.

Both tag the rows of their inputs and run over the union, so one processor
sees the two inputs of a key in arrival order (``seq``) and keeps the state of
both sides.
"""

from __future__ import annotations

import bisect
from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                       StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import JOIN_ARROW_INTERVAL
from ..operators.joins import DEFAULT_THRESHOLD, threshold_alert
from ..operators.windows import sensor_text, with_watermark

LEFT, RIGHT = "left", "right"
PAIR, LEFT_LATE, RIGHT_LATE = "pair", "left_late", "right_late"


class IntervalJoin(StatefulProcessor):
    """Join the rows of one key with ``l.ts + lower <= r.ts <= l.ts + upper``
    and give late rows (``ts`` below the watermark) a kind of their own.

    Each side is a buffer indexed by time: rows lie in buckets as wide as the
    interval, so a row meets at most three buckets of the other side. A bucket
    is read and written once per micro-batch, and a timer drops it as soon as
    no row in time can match it any more: a key's state holds what the
    watermark has not passed. Rows with a null ``ts`` match nothing and are not
    late; rows with a null key match nothing.
    """

    SCHEMA = StructType([StructField("kind", StringType()), StructField("id", StringType()),
                         StructField("l_ts", LongType()), StructField("l_vc", IntegerType()),
                         StructField("r_ts", LongType()), StructField("r_vc", IntegerType()),
                         StructField("seq", LongType()), StructField("wm", LongType())])

    def __init__(self, lower_s: int = -2, upper_s: int = 1):
        self.lower, self.upper = lower_s, upper_s
        self.width = max(upper_s - lower_s, 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        value = "ts array<bigint>, vc array<int>"
        self.state = {LEFT: handle.getMapState("left", "bucket bigint", value),
                      RIGHT: handle.getMapState("right", "bucket bigint", value)}

    def _expires(self, side: str, bucket: int) -> int:
        """First watermark (seconds) at which nothing can match the bucket."""
        last = (bucket + 1) * self.width - 1
        return last + 1 + (self.upper if side == LEFT else -self.lower)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        wm_ms = timerValues.getCurrentWatermarkInMs()
        wm = wm_ms // 1000 if wm_ms > 0 else None  # none before both inputs have rows
        held: dict[tuple[str, int], list[list]] = {}
        dirty: set[tuple[str, int]] = set()

        def bucket(side: str, b: int) -> list[list]:
            if (side, b) not in held:
                s = self.state[side]
                held[side, b] = [list(x) for x in s.getValue((b,))] if s.containsKey((b,)) else [[], []]
            return held[side, b]

        for r in sorted(rows, key=lambda r: (r.seq is None, r.seq)):
            if r.ts is None:
                continue
            if wm is not None and r.ts < wm:
                own = {"l_ts": r.ts, "l_vc": r.vc, "r_ts": None, "r_vc": None}
                if r.side == RIGHT:
                    own = {"l_ts": None, "l_vc": None, "r_ts": r.ts, "r_vc": r.vc}
                yield Row(kind=LEFT_LATE if r.side == LEFT else RIGHT_LATE, id=key[0], **own, seq=r.seq, wm=wm)
                continue
            if key[0] is None:
                continue
            low, high = ((r.ts + self.lower, r.ts + self.upper) if r.side == LEFT
                         else (r.ts - self.upper, r.ts - self.lower))
            other = RIGHT if r.side == LEFT else LEFT
            for b in range(low // self.width, high // self.width + 1):
                for ts, vc in zip(*bucket(other, b)):
                    if low <= ts <= high:
                        mine, theirs = (r.ts, r.vc), (ts, vc)
                        l, rr = (mine, theirs) if r.side == LEFT else (theirs, mine)
                        yield Row(kind=PAIR, id=key[0], l_ts=l[0], l_vc=l[1], r_ts=rr[0], r_vc=rr[1], seq=r.seq, wm=wm)
            b = r.ts // self.width
            if wm is not None and self._expires(r.side, b) <= wm:
                continue
            ts, vc = bucket(r.side, b)
            if not ts:
                self.handle.registerTimer(self._expires(r.side, b) * 1000)
            ts.append(r.ts)
            vc.append(r.vc)
            dirty.add((r.side, b))
        for side, b in dirty:
            self.state[side].updateValue((b,), tuple(held[side, b]))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs() // 1000
        for side in (LEFT, RIGHT):
            # the one bucket of the side that expires now, if there is one
            b = (at - (self.upper if side == LEFT else -self.lower)) // self.width - 1
            if self._expires(side, b) == at and self.state[side].containsKey((b,)):
                self.state[side].removeKey((b,))
        return iter([])

    def close(self) -> None:
        pass


def interval_join_stream(left: DataFrame, right: DataFrame, lower_s: int = -2, upper_s: int = 1,
                         delay_s: int = 3) -> DataFrame:
    """Streaming interval join of ``id, ts, vc, seq`` rows with its two late
    side outputs: rows of kind ``pair``, ``left_late`` and ``right_late``
    (:func:`join_pairs`, :func:`late_rows`).

    Each input carries its own watermark (``max ts - delay``); Spark's minimum
    over the inputs, 0 before one of them has rows, is the join's. The event
    time column ends before the join, so Spark drops no row itself. The
    watermark moves between micro-batches.
    """
    def tagged(df: DataFrame, side: str) -> DataFrame:
        return with_watermark(df, delay_s).select("id", "ts", F.col("vc").cast("int").alias("vc"), "seq", F.lit(side).alias("side"))

    both = tagged(left, LEFT).unionByName(tagged(right, RIGHT))
    return both.groupBy("id").transformWithState(IntervalJoin(lower_s, upper_s), IntervalJoin.SCHEMA, "Append", "EventTime")


def join_pairs(joined: DataFrame) -> DataFrame:
    """The join's main output, with the columns of the batch form."""
    return joined.where(F.col("kind") == PAIR).select(
        "id", "l_ts", "l_vc", "r_ts", "r_vc",
        F.concat(sensor_text(F.col("id"), F.col("l_ts"), F.col("l_vc")), F.lit(JOIN_ARROW_INTERVAL),
                 sensor_text(F.col("id"), F.col("r_ts"), F.col("r_vc"))).alias("text"))


def late_rows(joined: DataFrame) -> DataFrame:
    """The join's two side outputs, with the columns of the batch form."""
    is_left = F.col("kind") == LEFT_LATE
    return joined.where(F.col("kind").isin(LEFT_LATE, RIGHT_LATE)).select(
        F.when(is_left, LEFT).otherwise(RIGHT).alias("side"), "id", F.coalesce("l_ts", "r_ts").alias("ts"),
        F.when(is_left, F.col("l_vc")).otherwise(F.col("r_vc")).alias("vc"), "seq", "wm")


class ReplicatedThreshold(StatefulProcessor):
    """A shard's copy of the config stream and its share of the data rows.

    Config rows are kept by arrival; a data row takes the latest one that
    arrived before it. With ``max_disorder``, rows arrive at most so many
    ``seq`` numbers late, and configs that no row can take any more go.
    """

    SCHEMA = StructType([StructField("id", StringType()), StructField("ts", LongType()),
                         StructField("vc", IntegerType()), StructField("seq", LongType()),
                         StructField("threshold", IntegerType())])

    def __init__(self, default: int = DEFAULT_THRESHOLD, max_disorder: int | None = None):
        self.default, self.max_disorder = default, max_disorder

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.configs = handle.getMapState("configs", "seq bigint", "threshold int")
        self.latest = handle.getValueState("latest", "seq bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        data, top = [], self.latest.get()[0] if self.latest.exists() else None
        for r in rows:
            top = r.seq if top is None else max(top, r.seq)
            if r.is_config:
                if r.threshold is not None:  # a config row without a value changes nothing
                    self.configs.updateValue((r.seq,), (r.threshold,))
            else:
                data.append(r)
        known = sorted((seq, t) for (seq,), (t,) in self.configs.iterator())
        stamps = [seq for seq, _ in known]
        for r in sorted(data, key=lambda r: r.seq):
            at = bisect.bisect_left(stamps, r.seq)
            threshold = known[at - 1][1] if at else self.default
            if r.vc is not None and r.vc >= threshold:
                yield Row(id=r.id, ts=r.ts, vc=r.vc, seq=r.seq, threshold=threshold)
        if top is not None:
            self.latest.update((top,))
        if self.max_disorder is not None and top is not None:
            for seq in stamps[:max(0, bisect.bisect_left(stamps, top - self.max_disorder) - 1)]:
                self.configs.removeKey((seq,))

    def close(self) -> None:
        pass


def broadcast_threshold_stream(data: DataFrame, config: DataFrame, shards: int = 64,
                               max_disorder: int | None = None) -> DataFrame:
    """The broadcast-threshold job on two streams: ``data`` (``id, ts, vc,
    seq``) and ``config`` (``threshold, seq``), as the batch form gives it.

    Data rows go to ``shards`` shards by their content, so that a hot id is
    spread too; every config row is copied to each shard, where it becomes
    state. Config and data may be interleaved within a micro-batch, and the
    state survives a restart.
    """
    d = data.select(F.pmod(F.xxhash64("id", "seq"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("is_config"),
                    "id", "ts", F.col("vc").cast("int").alias("vc"), "seq", F.lit(None).cast("int").alias("threshold"))
    c = config.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_config"),
                      F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("ts"),
                      F.lit(None).cast("int").alias("vc"), "seq", F.col("threshold").cast("int").alias("threshold"))
    out = d.unionByName(c).groupBy("shard").transformWithState(
        ReplicatedThreshold(max_disorder=max_disorder), ReplicatedThreshold.SCHEMA, "Append", "None")
    return out.withColumn("text", threshold_alert(F.col("id"), F.col("ts"), F.col("vc"), F.col("threshold")))

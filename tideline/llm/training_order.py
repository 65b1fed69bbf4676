"""Token sequences written in training order.

The corpus is one stream of token ids, an end token after each document, cut
into sequences of equal length. A keyed Feistel permutation with cycle-walking
gives every sequence number a slot, one to one, with no table of the
permutation anywhere. Slots are range-partitioned, and each range writes
shards of fixed-stride sequences: the bytes of slot s are in shard
``s // per_shard`` at ``(s % per_shard) * stride``, so a reader goes through
the files in order and resumes at any slot.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut, frugal

#: Tokens of a sequence, and sequences of a shard: shards of 1 MB.
SEQUENCE = 1024
PER_SHARD = 512
#: Shards that a range partition writes on average.
SHARDS_PER_TASK = 16
#: Words that a task keeps encoded; no second Python stage shares its memory.
KEEP_WORDS = 1_000_000
#: Bytes of text that are encoded together: fewer passes over the merges' ranks.
ENCODE_CHARS = 12_000_000
KEY = "training-order"
ROUNDS = 6


class Feistel:
    """A keyed permutation of ``0 .. n - 1``."""

    def __init__(self, n: int, key: str = KEY):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        seed = hashlib.sha256(key.encode()).digest() + hashlib.sha256(b"2" + key.encode()).digest()
        self.keys = np.frombuffer(seed, "<u8")[:ROUNDS]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._round(left, k), left
            else:
                left, right = right, left ^ self._round(right, k)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        """Apply the permutation of the power of four above n until every
        value lies below n again; the walk ends as the value it began with does."""
        out = self._once(np.asarray(x).astype(np.uint64), back)
        while True:
            beyond = out >= np.uint64(self.n)
            if not beyond.any():
                return out.astype(np.int64)
            out[beyond] = self._once(out[beyond], back)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


def _end_token(t: bpe.Tokenizer) -> int:
    if len(t.bytes_of) > 1 << 16:
        raise ValueError("shards hold 16-bit ids")
    return next(iter(t.special.values()))


def tokens(docs: DataFrame, path: str, text: str = "text", place: tuple[str, str] | None = None) -> DataFrame:
    """``file, first, start, n, ids``: each document's ids, 16 bits each with
    the end token, and where it stands in the stream of its run. A run is a
    piece of a file that the scan reads in one go, ``first`` where it begins:
    ``place`` names the columns of both. Without them a run is a part of the scan."""
    kept = [F.col(text).alias("text")]
    kept += [F.col(place[0]).alias("file"), F.col(place[1]).cast("bigint").alias("first")] if place else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = bpe.tokenizer(path)
        end = _end_token(t)
        now, at = ("", TaskContext.get().partitionId()), 0
        for batch, rows in t.encode_texts(bpe._slices(batches, "text", ENCODE_CHARS), KEEP_WORDS):
            packed = [np.append(r, end).astype("<u2").tobytes() for r in rows]
            files, firsts, starts = [], [], []
            for k, raw in enumerate(packed):
                if place and (own := (batch.column("file")[k].as_py(), batch.column("first")[k].as_py())) != now:
                    now, at = own, 0
                files.append(now[0])
                firsts.append(now[1])
                starts.append(at)
                at += len(raw) // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(firsts, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array([len(p) // 2 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
                ["file", "first", "start", "n", "ids"])

    return docs.select(*kept).mapInArrow(frugal(run), "file string, first bigint, start bigint, n bigint, ids binary")


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder that driver and executors share."""
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pyarrow.fs.LocalFileSystem(), uri)


def write_shards(docs: DataFrame, path: str, folder: str, text: str = "text", sequence: int = SEQUENCE,
                 per_shard: int = PER_SHARD, key: str = KEY, place: tuple[str, str] | None = None) -> DataFrame:
    """Write the shards of ``docs`` into the shared ``folder`` and return their
    manifest: ``shard, first_slot, n_sequences, n_bytes, sha256``.

    With ``place``, the columns of a row's file and of the place in it where
    the piece begins that the scan reads in one go (``_metadata.file_path`` and
    ``_metadata.file_block_start``), documents stand in the stream in the order
    of files and rows: a table gives the same shards on every run, however a
    cluster splits the scan, so a run can be resumed on another one. Without it they stand in the order of the scan's parts, which
    follows the cluster's size. The last sequence is filled up with end tokens. Null and empty texts are documents
    of an end token alone; repeated rows are there repeatedly; extra columns
    are not looked at. An empty table has no shards and an empty manifest.

    A task writes each shard under a name of its own and renames it: a task
    that is run again writes the same bytes over the same file.
    """
    spark = docs.sparkSession
    stream = cut(tokens(docs, path, text, place), "order-tokens", "zstd")
    # one row per piece of the scan, so every task can hold them
    parts = stream.groupBy("file", "first").agg(F.sum("n").alias("n"))
    before = Window.orderBy("file", "first").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("file", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    total = parts.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    n_sequences = -(-total // sequence)
    if not n_sequences:
        return spark.createDataFrame([], "shard bigint, first_slot bigint, n_sequences bigint, n_bytes bigint, sha256 string")
    order = Feistel(n_sequences, key)
    end = _end_token(bpe.tokenizer(path))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, places, pieces = [], [], []
            for base, start, ids in zip(*(batch.column(c) for c in ("base", "start", "ids"))):
                at, raw = base.as_py() + start.as_py(), ids.as_py()
                done = 0
                while done < len(raw):
                    number, place = divmod(at, sequence)
                    take = min(sequence - place, len(raw) // 2 - done // 2)
                    numbers.append(number)
                    places.append(place)
                    pieces.append(raw[done:done + 2 * take])
                    done += 2 * take
                    at += take
            slots = order.slot(np.array(numbers, np.int64)) if numbers else np.zeros(0, np.int64)
            # the pieces of a range go on as one compressed row
            ranges, places = slots // per_range, np.array(places, np.int32)
            turn = np.argsort(ranges, kind="stable")
            starts = np.flatnonzero(np.diff(ranges[turn], prepend=-1))
            groups = np.split(turn, starts[1:]) if len(turn) else []
            sizes = np.fromiter(map(len, pieces), np.int32, len(pieces))
            codec = pa.Codec("zstd", 3)
            bounds = np.append(starts, len(turn)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges[turn][starts].astype(np.int32)),
                 *(pa.ListArray.from_arrays(bounds, pa.array(x[turn])) for x in (slots, places, sizes)),
                 pa.array([codec.compress(b"".join([pieces[k] for k in g]), asbytes=True) for g in groups], pa.binary())],
                ["range", "slots", "places", "sizes", "ids"])

    n_shards = -(-n_sequences // per_shard)
    tasks = -(-n_shards // SHARDS_PER_TASK)
    per_range = per_shard * SHARDS_PER_TASK
    pieces = stream.join(F.broadcast(bases), ["file", "first"]).select("base", "start", "ids").mapInArrow(
        frugal(cut_up), "range int, slots array<bigint>, places array<int>, sizes array<int>, ids binary")
    ranged = pieces.repartitionById(int(tasks), "range").sortWithinPartitions("range")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        codec = pa.Codec("zstd", 3)
        now, buffer = None, None  # the shards of one range

        def finish() -> Iterator[pa.RecordBatch]:
            fs.create_dir(root, recursive=True)
            for begin in range(0, len(buffer), per_shard):
                shard, raw = (now * per_range + begin) // per_shard, buffer[begin:begin + per_shard].tobytes()
                own = f"{root}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(own) as out:
                    out.write(raw)
                fs.move(own, f"{root}/shard-{shard:012d}.bin")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) for v in (shard, shard * per_shard, len(raw) // (2 * sequence), len(raw),
                                             hashlib.sha256(raw).hexdigest())],
                    ["shard", "first_slot", "n_sequences", "n_bytes", "sha256"])

        for batch in batches:
            for k in range(batch.num_rows):
                number = batch.column("range")[k].as_py()
                if number != now:
                    if now is not None:
                        yield from finish()
                    now = number
                    buffer = np.full((min(per_range, n_sequences - now * per_range), sequence), end, "<u2")
                slots, places, sizes = (batch.column(c)[k].values.to_numpy() for c in ("slots", "places", "sizes"))
                ids = np.frombuffer(codec.decompress(batch.column("ids")[k].as_buffer(), int(sizes.sum())), "<u2")
                at = 0
                for slot, place, size in zip((slots - now * per_range).tolist(), places.tolist(), (sizes // 2).tolist()):
                    buffer[slot, place:place + size] = ids[at:at + size]
                    at += size
        if now is not None:
            yield from finish()

    manifest = ranged.mapInArrow(frugal(write), "shard bigint, first_slot bigint, n_sequences bigint, n_bytes bigint, sha256 string")
    return cut(manifest, "order-manifest")


def read_shards(spark: SparkSession, folder: str, sequence: int = SEQUENCE, per_shard: int = PER_SHARD,
                from_slot: int = 0) -> DataFrame:
    """``slot, shard, ids`` (16-bit, binary) of the sequences from a slot on."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder)
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("bigint")
    files = files.select(shard.alias("shard"), "content").where(F.col("shard") >= from_slot // per_shard)
    stride = 2 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard_, content in zip(batch.column("shard"), batch.column("content")):
                s, raw = shard_.as_py(), content.as_py()
                slots = np.arange(len(raw) // stride) + s * per_shard
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array(np.full(len(slots), s)),
                     pa.array([raw[k:k + stride] for k in range(0, len(raw), stride)], pa.binary())],
                    ["slot", "shard", "ids"])

    return files.mapInArrow(frugal(run), "slot bigint, shard bigint, ids binary").where(F.col("slot") >= from_slot)


def with_sequence(slots: DataFrame, n_sequences: int, key: str = KEY) -> DataFrame:
    """Add ``sequence``: the number in the stream of each slot's sequence."""
    order = Feistel(max(1, n_sequences), key)

    @F.pandas_udf("long")
    def number(slot: pd.Series) -> pd.Series:
        return pd.Series(order.sequence(slot.to_numpy()) if len(slot) else [], dtype="int64")

    return slots.withColumn("sequence", number("slot"))

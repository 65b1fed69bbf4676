"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Rows get a number when their normalised texts are written; 2^20 consecutive
numbers of one part of the scan are a *sender*. A sender sorts its distinct
fingerprints, cuts them by range among *owners* and sends each owner its piece
as Golomb-coded gaps. The owner answers every piece with a bitmap: bit i says
that fingerprint i came from another piece too. A sender's answers become one
file in the shared folder; a task that reads the sender's rows again holds
that file and nothing else, and lets only suspects through. Suspects alone are
shuffled with their texts and compared byte by byte, equal texts of a task
first folded into one row. Fingerprints are short (about ten bits more than
the number of rows needs), so a row is a suspect by chance once in 1000.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, frugal
from .training_order import filesystem

#: Row numbers that are one sender: a task holds the fingerprints of one.
SENDER_BITS = 20
#: Fingerprints that an owner holds on average, of large and of small tables.
OWNER_ROWS, SMALL_OWNER_ROWS, SMALL_OWNERS = 1 << 22, 1 << 12, 64
#: Bits of a fingerprint beyond the number of rows, and their least number.
SPARE_BITS, LEAST_BITS = 10, 24
#: Groups of at least this many rows are handed out by broadcast. There are at
#: most rows / HOT_ROWS of them, and at most HOT_GROUPS on any table.
HOT_ROWS, HOT_GROUPS = 1024, 1 << 16

SPACE_RUN = r"[\x20\x09-\x0D]+"
# only the runs that the replacement changes
_CHANGED_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.coalesce(F.regexp_replace(text, _CHANGED_RUN, " "), F.lit(""))


def golomb_encode(values: np.ndarray, divisor_bits: int) -> bytes:
    """Gaps of sorted distinct numbers (the first one from -1), less one, each
    as a quotient in unary and a remainder of ``divisor_bits`` bits; all
    quotients stand before all remainders."""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(-1)) - 1
    quotients = gaps >> divisor_bits
    ones = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, np.uint8)
    unary[ones] = 1
    rest = gaps[:, None] >> np.arange(divisor_bits, dtype=np.int64)[None, :] & 1
    return np.packbits(unary).tobytes() + np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def golomb_decode(code: bytes, n: int, divisor_bits: int) -> np.ndarray:
    """The ``n`` numbers that :func:`golomb_encode` has coded."""
    if not n:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(code, np.uint8)
    tail = (n * divisor_bits + 7) // 8
    ones = np.flatnonzero(np.unpackbits(raw[:len(raw) - tail]))[:n]
    quotients = np.diff(ones, prepend=-1) - 1
    bits = np.unpackbits(raw[len(raw) - tail:])[:n * divisor_bits].reshape(n, divisor_bits)
    gaps = (quotients << divisor_bits) + bits.astype(np.int64) @ (np.int64(1) << np.arange(divisor_bits, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1


def divisor_bits(width: int, n: int) -> int:
    """Bits of the divisor near ln 2 times the mean gap of n numbers in ``width``."""
    return max(0, int(0.69 * width / max(n, 1)).bit_length() - 1)


class Ranges:
    """Where the fingerprints of a table of ``rows`` rows lie and who owns them."""

    def __init__(self, rows: int):
        self.bits = min(62, max(LEAST_BITS, rows.bit_length() + SPARE_BITS))
        self.owners = max(1, -(-rows // OWNER_ROWS), min(SMALL_OWNERS, -(-rows // SMALL_OWNER_ROWS)))
        self.width = -(-(1 << self.bits) // self.owners)

    def short(self, full: np.ndarray) -> np.ndarray:
        """Fingerprints of this table from 64-bit hashes."""
        return (full.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)


def messages(rows: DataFrame, ranges: Ranges) -> DataFrame:
    """``sender, part, owner, n, code, twice`` from ``row, fp``: the coded
    pieces, and a bitmap of the fingerprints that the piece's own rows repeat.
    A sender that the scan has split sends once per part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sender = part = None

        def send() -> pa.RecordBatch:
            fps, counts = np.unique(ranges.short(np.concatenate(held)), return_counts=True)
            owners = fps // ranges.width
            first = np.flatnonzero(np.diff(owners, prepend=-1))
            ends = np.append(first[1:], len(fps))
            out = []
            for a, b in zip(first.tolist(), ends.tolist()):
                own = int(owners[a])
                code = golomb_encode(fps[a:b] - own * ranges.width, divisor_bits(ranges.width, b - a))
                out.append((sender, part, own, b - a, code, np.packbits(counts[a:b] > 1).tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              ["sender", "part", "owner", "n", "code", "twice"])

        for batch in batches:
            row = batch.column("row").to_numpy()
            fp = batch.column("fp").to_numpy()
            of = row >> SENDER_BITS
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(row)]):
                if of[a] != sender:
                    if held:
                        yield send()
                    held, sender, part = [], int(of[a]), int(row[a])
                held.append(fp[a:b])
        if held:
            yield send()

    return rows.select("row", "fp").mapInArrow(
        frugal(run), "sender bigint, part bigint, owner bigint, n bigint, code binary, twice binary")


def answers(sent: DataFrame, ranges: Ranges) -> DataFrame:
    """``sender, part, owner, n, code, bitmap``: every piece with its
    duplicates marked, by the owners. An owner holds its range's fingerprints
    once per piece; the hash spreads distinct ones evenly, and a text of which
    there are many counts once in a piece."""
    def answer(table: pa.Table) -> pa.Table:
        ns, codes = table.column("n").to_pylist(), table.column("code").to_pylist()
        parts = [golomb_decode(c, n, divisor_bits(ranges.width, n)) for c, n in zip(codes, ns)]
        fps = np.concatenate(parts)
        order = np.argsort(fps, kind="stable")
        same = fps[order][1:] == fps[order][:-1]
        found = np.zeros(len(fps), bool)
        found[order[1:][same]] = True
        found[order[:-1][same]] = True
        pieces = np.split(found, np.cumsum(ns)[:-1])
        bitmaps = [np.packbits(np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) | f).tobytes()
                   for t, n, f in zip(table.column("twice").to_pylist(), ns, pieces)]
        return table.drop_columns(["twice"]).append_column("bitmap", pa.array(bitmaps, pa.binary()))

    return sent.groupBy("owner").applyInArrow(
        answer, "sender bigint, part bigint, owner bigint, n bigint, code binary, bitmap binary")


def deliver(answered: DataFrame, ranges: Ranges, folder: str) -> int:
    """Write each sender's marked fingerprints, sorted, as one file of the
    shared folder and return the number of files. A task that is run again
    writes the same bytes over the same file."""
    def write(table: pa.Table) -> pa.Table:
        marked = []
        for n, owner, code, bitmap in zip(*(table.column(c).to_pylist() for c in ("n", "owner", "code", "bitmap"))):
            fps = golomb_decode(code, n, divisor_bits(ranges.width, n)) + owner * ranges.width
            marked.append(fps[np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)])
        out = io.BytesIO()
        np.save(out, np.unique(np.concatenate(marked)))
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        own = f"{root}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as f:
            f.write(out.getvalue())
        fs.move(own, f"{root}/{table.column('sender')[0].as_py()}.npy")
        return table.select(["sender"]).slice(0, 1)

    return answered.groupBy("sender").applyInArrow(write, "sender bigint").count()


def suspect(ranges: Ranges, folder: str):
    """A boolean function of ``row`` and ``fp``: the row's fingerprint is marked."""
    @F.pandas_udf("boolean")
    def marked(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        fs, root = filesystem(folder)
        sender, known = None, np.zeros(0, np.int64)
        for row, fp in parts:
            of = row.to_numpy() >> SENDER_BITS
            short = ranges.short(fp.to_numpy())
            out = np.zeros(len(of), bool)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(of)]):
                if of[a] != sender:
                    sender = int(of[a])
                    with fs.open_input_stream(f"{root}/{sender}.npy") as f:
                        known = np.load(io.BytesIO(f.read()))
                if len(known):
                    at = np.minimum(np.searchsorted(known, short[a:b]), len(known) - 1)
                    out[a:b] = known[at] == short[a:b]
            yield pd.Series(out)

    return marked


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``, the columns named so whatever ``id_col`` is called.

    Texts are equal when they are byte for byte equal after every run of ASCII
    white space has become one space; a null text is empty, and all empty texts
    are one group. The row with the smallest id of a group stays; null ids come
    last, and a group of null ids alone keeps one row with a null ``keep_id``.
    Of rows with both the same id and an equal text one stays; rows with one id
    and different texts belong to their own groups. Other columns are not
    looked at, also ones with the names used here. An empty table gives an
    empty result. A text is held whole by one task at a time, at any length.

    ``id_col`` may be of any type that sorts. Rows are tied to the groups that
    the byte comparison has found by the SHA-256 of their text.
    """
    norm = normalised(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), norm.alias("text"))
    rows = cut(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.xxhash64("text").alias("fp"),
                           F.unhex(F.sha2("text", 256)).alias("sha")), "exact-rows")
    n = rows.count()
    ranges = Ranges(n)
    folder = scratch_path(docs.sparkSession, f"exact-bitmaps-{uuid.uuid4().hex}")
    if n:
        deliver(answers(cut(messages(rows, ranges), "exact-messages"), ranges), ranges, folder)
    is_suspect = suspect(ranges, folder)

    # byte verification: texts themselves are the key, folded in each task before the shuffle
    groups = (rows.where(is_suspect("row", "fp")).groupBy("text", "sha")
              .agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"),
                   F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("keep_row")))
    groups = cut(groups.select("sha", "group_size", "keep_id", "keep_row"), "exact-groups")
    slim = cut(rows.select("row", "doc_id", "sha", is_suspect("row", "fp").alias("suspect")), "exact-suspects")

    hot_rows = max(HOT_ROWS, n // HOT_GROUPS)
    suspects = slim.where("suspect").join(F.broadcast(groups.where(F.col("group_size") >= hot_rows)), "sha", "left")
    hot = suspects.where(F.col("group_size").isNotNull())
    cold = (suspects.where(F.col("group_size").isNull()).drop("group_size", "keep_id", "keep_row")
            .join(groups.where(F.col("group_size") < hot_rows).hint("shuffle_merge"), "sha"))
    alone = slim.where(~F.col("suspect")).select(
        "*", F.lit(1).cast("bigint").alias("group_size"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    return alone.unionByName(hot).unionByName(cold).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))

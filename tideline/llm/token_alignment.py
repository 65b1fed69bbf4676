"""Alignment of two tokenizers' tokens over the same bytes.

A text is cut into words that both tokenizers encode on their own, so a word's
tokens, groups and links are found once per distinct word of a task. An array
maps each A id to the B id of the same bytes. Links along that map, the
one-to-one groups, are counted in a vector of the length of A's vocabulary,
which tasks sum up and exchange in slices; only the other links' id pairs are
shuffled, counted per task first.

Scores need every pair's count. The vector, each A id's highest count and the
pairs with the highest counts go to all tasks: the pairs above the 2^20-th part
of all counts, which are fewer than 2^20. Rarer pairs are joined, none of them
in more documents than that part.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import cut, frugal, ragged_take

#: Words that a task keeps aligned.
KEEP_WORDS = 400_000
#: Ids of A in a slice of the vector, and tasks whose slices are summed at once.
SLICE, FAN_IN = 1024, 1024
#: Distinct pairs that a task counts before it hands them on.
PAIRS_HELD = 1 << 20
#: Pairs that go to every task number less than two to this power.
HEAD_BITS = 20

# A token of either vocabulary reaches across neither place: before a space or a line end behind a non-space.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_BARE = "\0bare "

_ALIGNED = ("row bigint, doc_id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "same binary, same_times binary, other binary, other_times binary")


def _ragged(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as one array and the offsets of each."""
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


class Aligner:
    """A byte-level BPE vocabulary (A) and a piece model with byte fallback (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.a = bpe.tokenizer(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.a.bytes_of), len(pieces)) > 1 << 16:
            raise ValueError("an id pair is held in 32 bits")
        if any("\n" in p or re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{path_b}: a piece reaches across a word's end")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        own = {raw: i for i, raw in enumerate(self.bytes_b) if self.b.is_byte(i)}
        own |= {raw: i for i, raw in enumerate(self.bytes_b)
                if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))}
        #: B id of the same bytes for each A id, or -1.
        self.same = np.array([own.get(raw, -1) for raw in self.a.bytes_of], np.int64)
        self.flat_a, self.off_a = _ragged(self.a.bytes_of)
        self.flat_b, self.off_b = _ragged(self.bytes_b)
        # each id in decimal digits with each of the three marks behind it
        ids = range(max(len(self.a.bytes_of), len(pieces)))
        self.marked, self.off_marked = _ragged([f"{i}{mark}".encode() for i in ids for mark in ",|;"])

    def word_keys(self, text: str) -> list[str]:
        """The words of a space and the text: runs of white space with what
        follows, less a first space, or behind ``_BARE`` those without one."""
        if bpe._TWO_SPACES.search(text) or text[0].isspace() or text[-1].isspace():
            return [p[1:] if p[0] == " " else _BARE + p for p in _CUT.split(" " + text)]
        first, *lines = text.split("\n")
        keys = first.split(" ")
        for line in lines:
            at = len(keys)
            keys += line.split(" ")
            keys[at] = f"{_BARE}\n{keys[at]}"
        return keys

    def align(self, keys: list[str]) -> dict[str, np.ndarray]:
        """Of each word: whether both encodings give its bytes, its numbers of
        tokens and groups, its links' codes (A id << 16 | B id) and its groups
        as text (``text``, ``n_text`` bytes a word), each group followed by
        ``;``. Two ways to cut the same bytes overlap in as many pairs as there
        are places where either cuts."""
        words = [k[len(_BARE):] if k.startswith(_BARE) else " " + k for k in keys]
        n = len(words)
        raw = [w.encode() for w in words]
        lens = np.fromiter(map(len, raw), np.int64, n)
        ids_a, off_a = self.a.encode_words(words)
        lists_b = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for i in [i for i, w in enumerate(words) if w == " " or w[0] != " "]:
            # the model puts a space in front of what isn't empty
            lists_b[i] = [self.space] if words[i] == " " else lists_b[i][1:]
        n_a, n_b = np.diff(off_a), np.fromiter(map(len, lists_b), np.int64, n)
        ids_a = ids_a.astype(np.int64)
        ids_b = np.fromiter(chain.from_iterable(lists_b), np.int64, int(n_b.sum()))

        whole = np.frombuffer(b"".join(raw), np.uint8)
        good = self._gives(self.flat_a, self.off_a, ids_a, n_a, whole, lens) & self._gives(
            self.flat_b, self.off_b, ids_b, n_b, whole, lens)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b, lens = n_a * good, n_b * good, lens * good
        # a mark at the last byte of each token; how many tokens have ended before each byte
        ends_a, ends_b = np.cumsum(np.diff(self.off_a)[ids_a]) - 1, np.cumsum(np.diff(self.off_b)[ids_b]) - 1
        total = int(lens.sum())
        in_a, in_b = np.zeros(total, bool), np.zeros(total, bool)
        in_a[ends_a], in_b[ends_b] = True, True
        before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        bounds, cuts = np.flatnonzero(in_a | in_b), np.flatnonzero(in_a & in_b)
        codes = (ids_a[before_a[bounds]] << 16) | ids_b[before_b[bounds]]

        of_byte = np.repeat(np.arange(n), lens)
        n_groups, n_links = (np.bincount(of_byte[x], minlength=n) for x in (cuts, bounds))

        # texts: every token with the mark behind it, a group's A tokens before its B tokens
        last_a, last_b = in_b[ends_a], in_a[ends_b]
        upto_a, upto_b = before_a[cuts] + 1, before_b[cuts] + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        elements = np.zeros(len(ids_a) + len(ids_b), np.int64)
        elements[np.arange(len(ids_a)) + np.concatenate([[0], upto_b])[group_a]] = ids_a * 3 + last_a
        elements[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b * 3 + 2 * last_b
        text, sizes = ragged_take(self.marked, self.off_marked, elements)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        upto = np.concatenate([[0], np.cumsum(n_a + n_b)])
        return {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "codes": codes,
                "text": text, "n_text": np.diff(ends[upto])}

    @staticmethod
    def _gives(flat: np.ndarray, offsets: np.ndarray, ids: np.ndarray, counts: np.ndarray, whole: np.ndarray,
               lens: np.ndarray) -> np.ndarray:
        """Which words' tokens join up to the word's bytes."""
        raw, sizes = ragged_take(flat, offsets, ids)
        n = len(lens)
        got = np.bincount(np.repeat(np.arange(n), counts), sizes, minlength=n).astype(np.int64)
        good = got == lens
        same = raw[np.repeat(good, got)] == whole[np.repeat(good, lens)]
        if not same.all():
            good[np.repeat(np.flatnonzero(good), lens[good])[~same]] = False
        return good

    def documents(self, chunks: Iterator[tuple[pa.RecordBatch, list[str]]], keep: int = KEEP_WORDS) -> Iterator[pa.RecordBatch]:
        """Rows of :data:`_ALIGNED` for each chunk of documents."""
        number: defaultdict[str, int] = defaultdict()
        for batch, texts in chunks:
            if not number or len(number) > keep:
                number = defaultdict(count().__next__)
                known = {c: np.zeros(0, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "codes", "n_text")}
                known |= {"good": np.zeros(0, bool), "text": np.zeros(0, np.uint8)}
            before = len(number)
            rows = [np.fromiter(map(number.__getitem__, keys), np.int64, len(keys))
                    for keys in (self.word_keys(t) if t else [] for t in texts)]
            fresh = self.align(list(islice(number, before, None)))
            known = {c: np.concatenate([v, fresh[c]]) for c, v in known.items()}
            links_upto, text_upto = (np.concatenate([[0], np.cumsum(known[c])]) for c in ("n_links", "n_text"))

            usable = [bool(len(r)) and bool(known["good"][r].all()) for r in rows]
            rows = [r if ok else r[:0] for r, ok in zip(rows, usable)]
            words = np.concatenate(rows)
            ends = np.cumsum([len(r) for r in rows])
            codes, lens = ragged_take(known["codes"], links_upto, words)
            doc = np.repeat(np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0)), lens)
            pairs, times = np.unique((doc << 32) | codes, return_counts=True)
            doc, codes = pairs >> 32, pairs & 0xFFFFFFFF
            same = self.same[codes >> 16] == (codes & 0xFFFF)

            def packed(mask: np.ndarray, values: np.ndarray) -> pa.Array:
                at = np.searchsorted(doc[mask], np.arange(len(rows) + 1)) * values.dtype.itemsize
                data = values[mask].tobytes()
                return pa.array([data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())

            times = times.astype("<u4")
            sums = {c: pa.array([int(known[c][r].sum()) for r in rows], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
            # the last group's mark is left out
            digests = [hashlib.sha256(ragged_take(known["text"], text_upto, r)[0][:-1]).hexdigest() if ok else ""
                       for r, ok in zip(rows, usable)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *sums.values(), pa.array(digests, pa.string()),
                 packed(same, (codes >> 16).astype("<u2")), packed(same, times),
                 packed(~same, codes.astype("<u4")), packed(~same, times)],
                ["row", "doc_id", *sums, "groups_sha256", "same", "same_times", "other", "other_times"])


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The two vocabularies at paths that every worker sees; kept per worker."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's numbers, groups and distinct links with how often it
    holds them: along the identity map as A ids, others as codes."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from aligner(path_a, path_b).documents(bpe._chunks(batches, "text"))

    return rows.mapInArrow(frugal(run), _ALIGNED.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _joined(cells: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), dtype).astype(np.int64)


def identity_counts(table: DataFrame, size: int) -> DataFrame:
    """``slice, counts``: the vector of documents per A id that is linked to its
    own bytes' B id, in slices of 64-bit numbers."""
    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vector = np.zeros(-(-size // SLICE) * SLICE, np.int64)
        for batch in batches:
            vector += np.bincount(_joined(batch.column("same"), "<u2"), minlength=len(vector))
        parts = [(k // SLICE, vector[k:k + SLICE]) for k in range(0, len(vector), SLICE)]
        parts = [(k, v.tobytes()) for k, v in parts if v.any()]
        team = TaskContext.get().partitionId() % FAN_IN
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in parts], pa.int32()), pa.array([team] * len(parts), pa.int32()),
             pa.array([v for _, v in parts], pa.binary())], ["slice", "team", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in rows.column("counts").to_pylist())
        return rows.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))

    kind = "slice int, team int, counts binary"
    # two levels: neither gathers the slices of more than so many tasks
    once = table.select("same").mapInArrow(frugal(count_up), kind).groupBy("slice", "team").applyInArrow(add, kind)
    return once.groupBy("slice").applyInArrow(add, kind).select("slice", "counts")


def pair_counts(table: DataFrame) -> DataFrame:
    """``code, n``: documents per linked id pair off the identity map."""
    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more, n = np.unique(_joined(batch.column("other"), "<u4"), return_counts=True)
            codes, at = np.unique(np.concatenate([codes, more]), return_inverse=True)
            ns = np.bincount(at, np.concatenate([ns, n]), minlength=len(codes)).astype(np.int64)
            if len(codes) > PAIRS_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(ns)], ["code", "n"])
                codes, ns = codes[:0], ns[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(ns)], ["code", "n"])

    return (table.select("other").mapInArrow(frugal(count_up), "code bigint, n bigint")
            .groupBy("code").agg(F.sum("n").alias("n")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256``.

    A space and the text are encoded by A, without special tokens, and the text
    by B, which puts the space there itself. Null and empty texts, and texts
    that either vocabulary does not give back byte for byte, have no tokens:
    zeros and an empty string, and they count for no pair. A pair's count is the
    number of rows that hold it linked; rows that stand there repeatedly count
    repeatedly. ``n_best`` are the links whose count is their A id's highest,
    ``count_sum`` the sum of all links' counts. Other columns are not looked
    at, whatever their names; an empty table gives an empty result. A long text
    is encoded whole, in words; a long word takes B's model some 50 bytes of
    memory a byte.
    """
    table = cut(aligned(docs, path_a, path_b, id_col, text), "align-documents", compression="zstd")
    spark = docs.sparkSession
    size = len(bpe.tokenizer(path_a).bytes_of)
    vector = np.zeros(-(-size // SLICE) * SLICE, np.int64)
    for r in identity_counts(table, size).collect():  # a vocabulary's length
        vector[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.int64)
    counts = cut(pair_counts(table), "align-pairs")
    total = counts.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    least = total >> HEAD_BITS
    best = vector.copy()
    for r in counts.groupBy((F.col("code") / (1 << 16)).cast("int").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = max(best[r["a"]], r["n"])
    # fewer than 2^HEAD_BITS pairs can be in more documents than that
    head = counts.where(F.col("n") > least).orderBy("code").toArrow()
    shared = spark.sparkContext.broadcast((vector, best, head.column("code").to_numpy(), head.column("n").to_numpy()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, best, codes, ns = shared.value
        for batch in batches:
            n_rows = batch.num_rows

            def of(column: str, width: int) -> np.ndarray:
                lens = [len(c) // width for c in batch.column(column).to_pylist()]
                return np.repeat(np.arange(n_rows), lens)

            a, times = _joined(batch.column("same"), "<u2"), _joined(batch.column("same_times"), "<u4")
            doc = of("same", 2)
            n_best, sums = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
            np.add.at(n_best, doc, times * (vector[a] == best[a]))
            np.add.at(sums, doc, times * vector[a])

            code, times = _joined(batch.column("other"), "<u4"), _joined(batch.column("other_times"), "<u4")
            doc = of("other", 4)
            at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            n = ns[at[known]] if len(codes) else np.zeros(0, np.int64)
            np.add.at(n_best, doc[known], times[known] * (n == best[code[known] >> 16]))
            np.add.at(sums, doc[known], times[known] * n)
            rare, upto = ~known, np.searchsorted(doc[~known], np.arange(n_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(upto), pa.array(v[rare])) for v in (code, times)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n_best), pa.array(sums), *lists],
                [*kept, "n_best", "count_sum", "rare", "rare_times"])

    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    id_kind = table.schema["doc_id"].dataType.simpleString()
    scored = cut(table.mapInArrow(
        frugal(score), _ALIGNED.format(id=id_kind).split(", same ")[0] + ", n_best bigint, count_sum bigint, "
        "rare array<bigint>, rare_times array<bigint>"), "align-scored")
    highest = spark.createDataFrame(list(enumerate(best.tolist())), "a int, best bigint")
    rare = (counts.where(F.col("n") <= least).withColumn("a", (F.col("code") / (1 << 16)).cast("int"))
            .join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("best")).cast("bigint").alias("is_best")))
    more = (scored.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r"))
            .select("row", F.col("r.rare").alias("code"), F.col("r.rare_times").alias("times"))
            .join(rare, "code").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("is_best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    zero = F.lit(0).cast("bigint")
    return scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), "groups_sha256")

"""Near-duplicate documents by ProbMinHash over weighted word shingles.

1. One pass over the texts gives every document a digest of its words and a
   ProbMinHash signature of its shingles, weighted by how often they occur:
   every shingle is a Poisson process whose rate is its weight, its arrivals
   fall on random components, and a component keeps the shingle that came
   first. A shingle stops once its next arrival lies behind the document's
   last component, so a document costs little more than one arrival per
   shingle. Two documents agree in a component with the probability of their
   probability Jaccard similarity.
2. Exact copies are one class; one document of each goes on.
3. Documents that agree in a band of components share a bucket. Members are
   compared with one leader of their bucket, never all with all, by the
   exact similarity of their shingles.
4. Buckets whose members are in several components after that get other
   leaders, drawn anew.
5. What is then left in buckets of several components is finished exactly: a
   prefix filter on the rarest shingles finds every pair that can be a link,
   nearly always once, at the first shingle that both prefixes hold, and those
   in different components are compared. A shingle of very many documents is spread over a
   grid of tasks.

What is compared are distinct texts (a number per digest); what links join are
document ids. An id on several texts links them.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import grid_join
from .common import cut, frugal
from .components import components

#: Words of a shingle, and the least similarity of a link.
SHINGLE = 5
SIMILARITY = 0.8
#: Bands of a signature and components of a band: a pair at the least
#: similarity shares no bucket with probability (1 - 0.8 ** 5) ** 24 = 7e-5.
BANDS, ROWS = 24, 5
#: Rounds in which open buckets get other leaders before the exact finish. They
#: lose nothing and only make components larger, so that fewer pairs are left.
LEADER_ROUNDS = 1
#: Rows of one shingle that a task of the exact finish meets.
SHINGLE_ROWS = 8192
#: Items before it that a row of a prefix carries, and rows of items or prefixes made at a time.
BEFORE, PREFIX_ROWS = 8, 100_000
#: 64-bit words of the bitmap of a set's items that such a row carries.
BITMAP = 8
#: Bytes of text whose signatures are made together.
SLICE_BYTES = 4_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's constants) of an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_words(text: str | None) -> list[bytes]:
    """Words of a text in lower case; none for null."""
    return [] if text is None else text.lower().encode("utf-8", "surrogatepass").split()


def text_digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


class WordHashes(defaultdict):
    """Word -> 64-bit hash, kept for the words of one slice."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Hashes of the shingles of a text, one per place; a text with fewer
    words than a shingle is one shingle, one without words has none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    acc = np.full(n, _GOLD if len(h) >= SHINGLE else np.uint64(len(h)))
    for k in range(min(SHINGLE, len(h))):
        acc = mix64(acc * np.uint64(31) + h[k:k + n])
    return acc


def signatures(items: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, ``n_docs x size``, of the weighted items of many
    documents. ``doc`` is each item's document, in ascending order. All
    documents go on side by side, round by round: in a round every item still
    alive has its next arrival."""
    first = np.full(n_docs * size, np.inf)
    value = np.zeros(n_docs * size, np.uint32)
    at = np.zeros(len(items))
    step = np.full(1, _GOLD)
    while len(items):
        draw = mix64(items + step)
        step = step + _GOLD
        at = at - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) / float(1 << 53)) / weights
        place = doc * size + (mix64(draw ^ _GOLD) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, place, at)
        won = first[place] == at
        value[place[won]] = (items[won] >> np.uint64(32)).astype(np.uint32)
        alive = at < first.reshape(n_docs, size).max(axis=1)[doc]
        items, weights, doc, at = items[alive], weights[alive], doc[alive], at[alive]
    return value.reshape(n_docs, size)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, which holds the band's number."""
    part = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), part.shape[:2])
    for k in range(ROWS):
        acc = mix64(acc * np.uint64(31) + part[:, :, k])
    return acc.view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches, "text"):
        hashes = WordHashes()
        digests, n_words, items, weights = [], [], [], []
        seen: dict[bytes, int] = {}  # digest -> place among the slice's distinct texts
        which = []
        for text in part.column("text").to_pylist():
            words = text_words(text)
            n_words.append(len(words))
            digest = text_digest(words)
            digests.append(digest)
            if digest not in seen:
                seen[digest] = len(seen)
                hashed, times = np.unique(shingles(words, hashes), return_counts=True)
                items.append(hashed)
                weights.append(times)
            which.append(seen[digest])
        doc = np.repeat(np.arange(len(items)), [len(x) for x in items])
        sign = signatures(np.concatenate(items), np.concatenate(weights).astype(float), doc, len(items), BANDS * ROWS)
        bands = band_hashes(sign)[which]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(digests, pa.binary()), pa.array(n_words, pa.int64()),
             pa.ListArray.from_arrays(np.arange(len(which) + 1, dtype=np.int32) * BANDS, bands.ravel())],
            ["doc_id", "text_hash", "digest", "n_words", "bands"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted 32-bit shingle hashes, and their counts where one is over 1, of
    the rows whose text has the wanted digest."""
    for part in _slices(batches, "text"):
        hashes = WordHashes()
        units, sets, times = [], [], []
        for unit, digest, text in zip(*(part.column(c).to_pylist() for c in ("unit", "digest", "text"))):
            words = text_words(text)
            if text_digest(words) != digest:
                continue  # another text with the same id and hash
            s, n = np.unique((shingles(words, hashes) >> np.uint64(32)).astype("<u4"), return_counts=True)
            units.append(unit)
            sets.append(s.tobytes())
            times.append(n.astype("<u4").tobytes() if len(n) and n.max() > 1 else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(units, pa.int64()), pa.array(sets, pa.binary()), pa.array(times, pa.binary())],
            ["unit", "shingles", "times"])


def similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray | None = None, wb: np.ndarray | None = None) -> float:
    """Probability Jaccard similarity of two weighted sets given as sorted
    distinct items; Jaccard's where all weights are 1. Two empty sets have 0."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    shared = int(both.sum())
    if wa is None and wb is None:
        return shared / (len(a) + len(b) - shared)
    wa = np.ones(len(a)) if wa is None else wa.astype(float)
    wb = np.ones(len(b)) if wb is None else wb.astype(float)
    x, y = wa[both], wb[at[both]]
    order = np.argsort(-x / y, kind="stable")
    x, y = x[order], y[order]
    # of the shared items those with a larger share in a count by it, the others by b
    in_a = wa.sum() - x.sum() + np.cumsum(x)
    in_b = wb.sum() - np.cumsum(y)
    return float((1 / (in_a / x + in_b / y)).sum())


def _linked(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array(cell):
            return np.frombuffer(cell.as_buffer(), "<u4") if cell.is_valid else None

        for batch in batches:
            keep = []
            for row in zip(*(batch.column(c) for c in ("a_set", "b_set", "a_times", "b_times"))):
                keep.append(similarity(*map(array, row)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a_rep"), batch.column("b_rep")], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per item of each set, with its count in the set."""
    def packed(units: list[int], sets: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sets).view(np.int32)), pa.array(np.repeat(units, [len(x) for x in sets]), pa.int64()),
             pa.array(np.concatenate(times).astype(np.int32))], ["token", "unit", "weight"])

    for batch in batches:
        units, sets, times, made = [], [], [], 0
        for unit, cell, counts in zip(*(batch.column(c) for c in ("unit", "shingles", "times"))):
            units.append(unit.as_py())
            sets.append(np.frombuffer(cell.as_buffer(), "<u4"))
            times.append(np.frombuffer(counts.as_buffer(), "<u4") if counts.is_valid else np.ones(len(sets[-1]), "<u4"))
            made += len(sets[-1])
            if made >= PREFIX_ROWS:
                yield packed(units, sets, times)
                units, sets, times, made = [], [], [], 0
        if units:
            yield packed(units, sets, times)


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """``unit, token, weight, n`` of each unit's rows, which stand together but
    may lie in several batches."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("unit", "token", "weight", "n")]
        starts = np.flatnonzero(np.diff(columns[0])) + 1
        for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
            part = [c[begin:end] for c in columns]
            if held and len(part[0]) and held[0][0][0] != part[0][0]:
                yield tuple(map(np.concatenate, zip(*held)))
                held = []
            if len(part[0]):
                held.append(part)
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def prefix(items: np.ndarray, weights: np.ndarray | None, ranks: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The first items of a set in the order of (rank, item), each with the
    inverse of the set's share of weight from it on, as far as that is at most
    ``1 / least``.

    With P and Q the shares of two sets' weights that their shared items have,
    the probability Jaccard similarity is at most ``1 / (1 / P + 1 / Q - 1)``:
    item by item it is at most the harmonic mean of ``p / (2 - P)`` and
    ``q / (2 - Q)``, which is concave. From its first shared item on a set has
    at least its shared weight, so two linked sets have an item in both
    prefixes whose two inverses are at most ``1 + 1 / least`` together."""
    order = np.lexsort((items, ranks))
    weight = np.ones(len(items)) if weights is None else weights[order].astype(float)
    from_here = weight[::-1].cumsum()[::-1]
    inverse = from_here[0] / from_here
    n = int(np.searchsorted(inverse, 1 / least + 1e-9, side="right"))
    return items[order[:n]], inverse[:n]


def bitmap(items: np.ndarray) -> np.ndarray:
    """A bit per item, by its hash. A bit that another set's bitmap hasn't got
    stands for at least one item that the other set hasn't got."""
    at = mix64(items.astype(np.uint64) ^ _GOLD) % np.uint64(64 * BITMAP)
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[at.astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _prefixes(least: float):
    """A row per item of each set's prefix that another set has, with the few
    such items before it, the set's bitmap and the least share of weight that
    one of its items has."""
    def packed(units: list[int], tokens: list[np.ndarray], inverses: list[np.ndarray], bits: list[np.ndarray],
               shares: list[float]) -> pa.RecordBatch:
        starts = np.concatenate([np.arange(len(t)) for t in tokens])
        flat = np.concatenate(tokens)
        # the items before the k-th of a set are the flat array's items before it
        lens = np.minimum(starts, BEFORE)
        at = np.repeat(np.arange(len(flat)) - lens, lens) + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        before = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32), pa.array(flat[at]))
        counts = [len(t) for t in tokens]
        bitmaps = np.repeat(np.array(bits), counts, axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(flat), pa.array(np.concatenate(inverses)), before,
             pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * BITMAP, bitmaps.ravel()),
             pa.array(np.repeat(np.array(shares), counts)), pa.array(np.repeat(units, counts), pa.int64())],
            ["token", "inverse", "before", "bits", "share", "unit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, tokens, inverses, bits, shares, made = [], [], [], [], [], 0
        for unit, items, weights, n in _by_unit(batches):
            order = np.argsort(items)
            items, weights, n = items[order], weights[order], n[order]
            token, inverse = prefix(items, weights, n, least)
            met = n[np.searchsorted(items, token)] > 1
            if not met.any():
                continue
            units.append(int(unit[0]))
            tokens.append(token[met])
            inverses.append(inverse[met])
            bits.append(bitmap(items.view(np.uint32)))
            shares.append(float(weights.min()) / float(weights.sum()))
            made += len(tokens[-1])
            if made >= PREFIX_ROWS:
                yield packed(units, tokens, inverses, bits, shares)
                units, tokens, inverses, bits, shares, made = [], [], [], [], [], 0
        if units:
            yield packed(units, tokens, inverses, bits, shares)

    return run


def _shared(a: str, b: str) -> Column:
    """The most of ``a``'s weight that ``b`` can share, by both bitmaps; at
    least a very small number."""
    alone = sum((F.bit_count(F.col(f"{a}_bits")[k].bitwiseAND(F.bitwise_not(F.col(f"{b}_bits")[k]))) for k in range(BITMAP)),
                F.lit(0))
    return F.greatest(F.lit(1e-9), 1 - alone * F.col(f"{a}_share"))


def _candidates(left: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``a, b, a_rep, b_rep``: all pairs of the texts of ``left`` (``unit, rep,
    component``) in different components that can be similar enough, by
    :func:`prefix`. Of a shingle's texts only those pairs are formed: one side
    is in the first half of the inverses' range, of the shingle's largest
    component no two meet, their bitmaps allow that they share as much weight as
    a link needs, and none of the few items before the shingle is the same in
    both prefixes -- a pair that shares one has met there or earlier,
    as the inverses only grow."""
    own = left.select("unit").join(sets, "unit")
    items = cut(own.mapInArrow(frugal(_items), "token int, unit bigint, weight int"), "near-dup-items")
    # how many sets have a shingle, of each that several have
    counts = cut(items.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-dup-counts")
    ranked = (items.join(counts, "token", "left").select("unit", "token", "weight", F.coalesce("n", F.lit(1)).alias("n"))
              .repartition("unit").sortWithinPartitions("unit"))
    prefixes = ranked.mapInArrow(frugal(_prefixes(least)), "token int, inverse double, before array<int>, bits array<bigint>, "
                                                           "share double, unit bigint")
    rows = cut(prefixes.join(left, "unit"), "near-dup-prefixes")
    both = 1 + 1 / least + 1e-9
    tokens = (rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"), F.min("inverse").alias("inverse"))
              .groupBy("token").agg(F.min("component").alias("__low"), F.max("component").alias("__high"),
                                    F.max(F.struct("n", "component")).getField("component").alias("hub"),
                                    F.min("inverse").alias("least"))
              .where((F.col("__low") < F.col("__high")) & (2 * F.col("least") <= both)).select("token", "hub", "least"))
    near = cut(rows.join(tokens, "token").where(F.col("inverse") + F.col("least") <= both)
               .withColumn("in_hub", F.col("component") == F.col("hub")).drop("hub", "least"), "near-dup-meeting")
    own_names = ["unit", "rep", "component", "inverse", "before", "bits", "share"]
    a = near.where(2 * F.col("inverse") <= both).select(
        "token", *[F.col(c).alias(f"a_{c}") for c in own_names],
        F.explode(F.when(F.col("in_hub"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("in_hub"))
    b = near.select("token", "in_hub", *[F.col(c).alias(f"b_{c}") for c in own_names])
    meet = grid_join(a, b, ["token", "in_hub"], SHINGLE_ROWS).where(
        (F.col("a_component") != F.col("b_component")) & (F.col("a_inverse") + F.col("b_inverse") <= both)
        & ((2 * F.col("b_inverse") > both) | (F.col("a_unit") < F.col("b_unit")))   # both in the first half: one way round
        & ~F.arrays_overlap("a_before", "b_before") & (1 / _shared("a", "b") + 1 / _shared("b", "a") <= both))
    swap = F.col("a_unit") > F.col("b_unit")
    either = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    return meet.select(either("a_unit", "b_unit").alias("a"), either("b_unit", "a_unit").alias("b"),
                       either("a_rep", "b_rep").alias("a_rep"), either("b_rep", "a_rep").alias("b_rep")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, kept, n_words``: one row per document, the class
    being the smallest id that links lead to. A link joins two documents whose
    five-word shingles, weighted by their counts, have a probability Jaccard
    similarity of at least ``least``; exact copies (equal words in lower case)
    have the same class as each other. ``kept`` is true for one document of
    each class.

    Documents without words, null texts included, are in no group: each is its
    own class. Rows with a null id are left out. An id on several rows is one
    document if the rows' words are equal, and else the class of all of them.
    Extra columns are not looked at; an empty table gives no rows. Ids are
    longs.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("text_hash")).where("doc_id is not null")
    signed = cut(rows.mapInArrow(
        frugal(_sign), "doc_id bigint, text_hash bigint, digest binary, n_words bigint, bands array<bigint>"),
        "near-dup-signatures")
    copies = (signed.where("n_words > 0").groupBy("digest")
              .agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.first("bands").alias("bands")))
    # a text's number is written with it, so it is the same wherever it is read
    banded = cut(copies.select(F.monotonically_increasing_id().alias("unit"), "digest", F.col("r.doc_id").alias("rep"),
                               F.col("r.text_hash").alias("text_hash"), "bands"), "near-dup-copies")
    # every row of an id points to its text's smallest id; an id that does so to several links them
    pointers = cut(signed.where("n_words > 0").select("doc_id", "digest").join(banded.select("digest", "rep"), "digest")
                   .select("doc_id", "rep"), "near-dup-pointers")
    several = (pointers.groupBy("doc_id").agg(F.min("rep").alias("__low"), F.max("rep").alias("__high"))
               .where("__low < __high").select("doc_id"))
    own_links = pointers.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()

    in_bands = banded.select("unit", "rep", F.explode("bands").alias("bucket"))
    shared = in_bands.groupBy("bucket").agg(F.min("unit").alias("leader"), F.max("unit").alias("__top"),
                                            F.min_by("rep", "unit").alias("leader_rep"))
    members = cut(in_bands.join(shared.where("leader < __top").drop("__top"), "bucket"), "near-dup-members")
    wanted = (banded.join(members.select("unit").distinct(), "unit", "left_semi")
              .select(F.col("rep").alias("doc_id"), "text_hash", "unit", "digest"))
    sets = cut(rows.join(wanted, ["doc_id", "text_hash"]).mapInArrow(
        frugal(_shingle_sets), "unit bigint, shingles binary, times binary").dropDuplicates(["unit"]), "near-dup-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("unit").alias(s), F.col("shingles").alias(f"{s}_set"), F.col("times").alias(f"{s}_times"))
                for s in "ab")
        return pairs.join(b, "b").join(a, "a").mapInArrow(frugal(_linked(least)), "a bigint, b bigint")

    def ordered(x: str, x_rep: str, y: str, y_rep: str) -> list[Column]:
        """Two texts as one pair, whichever way round they were met."""
        swap = F.col(x) > F.col(y)
        return [F.when(swap, F.col(q)).otherwise(F.col(p)).alias(n) for p, q, n in (
            (x, y, "a"), (y, x, "b"), (x_rep, y_rep, "a_rep"), (y_rep, x_rep, "b_rep"))]

    # texts of one id are linked by it
    first = (members.where("unit <> leader and rep <> leader_rep")
             .select(*ordered("unit", "rep", "leader", "leader_rep")).distinct())
    links = cut(verified(first).unionByName(own_links), "near-dup-links")
    found = cut(components(links), "near-dup-components")
    for turn in range(1, LEADER_ROUNDS + 2):
        now = members.select("bucket", "unit", "rep").join(
            found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
            "bucket", "unit", "rep", F.coalesce("component", "rep").alias("component"))
        open_ = now.groupBy("bucket").agg(
            F.min("component").alias("__low"), F.max("component").alias("__high"),
            F.min_by(F.struct("unit", "rep", "component"), F.xxhash64("unit", "bucket", F.lit(turn))).alias("leader"))
        still = now.join(open_.where("__low < __high"), "bucket")
        if turn > LEADER_ROUNDS:
            left = cut(still.select("unit", "rep", "component").distinct(), "near-dup-open")
            pairs = None if left.isEmpty() else _candidates(left, sets, least)
        else:
            pairs = (still.where("component <> leader.component")
                     .select(*ordered("unit", "rep", "leader.unit", "leader.rep")).distinct())
        if pairs is None:
            break
        new = cut(verified(pairs), "near-dup-links")
        if not new.isEmpty():
            stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = cut(components(stars.unionByName(new)), "near-dup-components")

    classes = (pointers.join(found.withColumnRenamed("node", "rep"), "rep", "left")
               .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("class_id")))
    ids = signed.groupBy("doc_id").agg(F.max("n_words").alias("n_words"))
    return (ids.join(classes, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    (F.coalesce("class_id", "doc_id") == F.col("doc_id")).alias("kept"), "n_words"))


def keep_one(docs: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The documents of which :func:`near_duplicates` keeps one per class, all
    columns of ``docs``. Of a kept id one row stays for each of its texts
    (equal up to case and white space). Rows without an id, which no class can
    name, stay."""
    kept = near_duplicates(docs, text, least).where("kept").select(F.col("doc_id").alias("__kept"))
    same = docs.join(kept, F.col("doc_id").cast("bigint") == F.col("__kept"))
    words = F.xxhash64(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\x20\\x09-\\x0D]+", " ")))
    return (same.withColumn("__words", words).dropDuplicates(["__kept", "__words"]).drop("__kept", "__words")
            .unionByName(docs.where("doc_id is null")))

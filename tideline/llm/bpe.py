"""BPE encoding and decoding with a pair occurrence index.

A task reads its documents in chunks of bounded size, cuts them into words
that can be encoded on their own, and encodes each distinct word once. Words
and pre-tokens are places in a chunk's bytes, found and numbered by array
operations; no Python object is made for one. All distinct pre-tokens of a
chunk lie in one symbol array; the index maps the rank of each mergeable pair
to all its positions there. Ranks are applied in ascending order: a rank's
positions are merged together, the neighbours' new pairs join the lists of
their own (always later) ranks, and lists of ranks that have gone stale are
skipped when their turn comes. One long word therefore costs about
n log n, not n squared.

Ids are a binary column, little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import frugal, ragged_take, without

#: Characters of text that a task holds at a time, words that it keeps encoded.
CHUNK_CHARS = 3_000_000
KEEP_WORDS = 300_000
#: Bytes of distinct pre-tokens that are encoded together.
PRETOKEN_CHARS = 4_000_000
#: Words whose ids are put together at a time.
TAKE_WORDS = 300_000
#: Texts that are decoded together.
DECODE_ROWS = 1000

_TWO_SPACES = re.compile(r"\s\s")

# Fixed values of the public byte-level format: the pre-token pattern and the
# printable characters that stand for themselves in its alphabet.
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_KINDS = [regex.compile(k, regex.DOTALL) for k in (r"\s", r"\p{L}", r"\p{N}", ".")]
_SPACE, _UNKNOWN = 0, 255
PRINTABLE = [(33, 126), (161, 172), (174, 255)]


def _spaces() -> dict[int, np.ndarray]:
    """First byte -> the bytes behind it, as one number, of the white space
    beyond ASCII. What any of the libraries takes for white space is here: a
    word must not be cut beside what may be either."""
    found: dict[int, list[int]] = {}
    for c in map(chr, range(0x80, 0x3001)):
        if c.isspace() or c == "\u180e" or regex.match(r"\s", c):
            raw = c.encode()
            found.setdefault(raw[0], []).append(int.from_bytes(raw[1:], "big"))
    return {lead: np.array(tails) for lead, tails in found.items()}


_SPACES = _spaces()


def byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte. Bytes that print stand
    for themselves; the others take the characters from U+0100 on, in order."""
    own = {b for lo, hi in PRINTABLE for b in range(lo, hi + 1)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def _flat(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of large strings without nulls, joined, and the offsets of each."""
    if not len(cells):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset:cells.offset + len(cells) + 1]
    raw = np.frombuffer(cells.buffers()[2] or b"", np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _column(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The column of large strings that lie side by side in ``raw``."""
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


class Tokenizer:
    """A byte-level BPE vocabulary file, ready for array work."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        vocab: dict[str, int] = spec["model"]["vocab"]
        byte_of = byte_alphabet()
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = (bytes(byte_of[c] for c in token) if all(c in byte_of for c in token)
                                else token.encode())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_re = re.compile("|".join(map(re.escape, names)).encode()) if names else None

        self.byte_id = np.array([vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        born = np.full(size, -1, np.int64)
        born[self.made[::-1]] = np.arange(len(merges))[::-1]
        if (np.maximum(born[self.left], born[self.right]) >= np.arange(len(merges))).any():
            raise ValueError(f"{path}: a merge stands before the merge that makes its part")
        self.base = size
        keys = self.left * size + self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        # short integers sort faster; the ranks of pairs of bytes need no search
        self.rank_type = np.uint16 if len(merges) <= 1 << 16 else np.int32
        self.byte_rank = self.ranks(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)).reshape(256, 256)
        #: Of each code point: white space, letter, number, other; unknown until it is met.
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where they don't merge."""
        k = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.key_rank[at], np.int32(-1))

    def encode_pretokens(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens, given as joined bytes and the offsets of
        each, joined, and the offsets of each."""
        lens, n = np.diff(offsets), len(raw)
        sym = self.byte_id[raw]
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[offsets[1:][lens > 0] - 1] = -1
        prv[offsets[:-1][lens > 0]] = -1

        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def index(at: np.ndarray, rank: np.ndarray) -> None:
            """Put the pairs of these ranks, that begin at these positions, into their ranks' lists."""
            at, rank = at[rank >= 0], rank[rank >= 0].astype(self.rank_type)
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            bounds = [*first.tolist(), len(at)]
            for r, begin, end in zip(rank[first].tolist(), bounds, bounds[1:]):
                if r in lists:
                    lists[r].append(at[begin:end])
                else:
                    lists[r] = [at[begin:end]]
                    heapq.heappush(heap, r)

        at = np.flatnonzero(nxt >= 0).astype(np.int32)
        index(at, self.byte_rank[raw[at], raw[at + 1]])
        while heap:
            r = heapq.heappop(heap)
            parts = lists.pop(r)
            a, b = self.left[r], self.right[r]
            p = parts[0] if len(parts) == 1 else distinct(np.concatenate(parts))
            p = p[(sym[p] == a) & (nxt[p] >= 0)]
            p = p[sym[nxt[p]] == b]
            if a == b and len(p) > 1:  # of overlapping pairs every second one, from the left
                i = np.arange(len(p))
                start = np.concatenate([[True], nxt[p[:-1]] != p[1:]])
                p = p[(i - np.maximum.accumulate(np.where(start, i, 0))) % 2 == 0]
            if not len(p):
                continue
            q = nxt[p]
            after = nxt[q]
            sym[p], sym[q], nxt[p] = self.made[r], -1, after
            prv[after[after >= 0]] = p[after >= 0]
            before = prv[p]
            at = distinct(np.concatenate([before[before >= 0], p[after >= 0]]))
            index(at, self.ranks(sym[at], sym[nxt[at]]))
        alive = sym >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])
        return sym[alive], counts[offsets]

    def _encode_bounded(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode_pretokens` of at most :data:`PRETOKEN_CHARS` bytes at a time, a longer one alone."""
        ids, ends, begin = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while begin < len(offsets) - 1:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PRETOKEN_CHARS, side="right")) - 1)
            own = offsets[begin:end + 1]
            flat, upto = self.encode_pretokens(raw[own[0]:own[-1]], own - own[0])
            ids.append(flat)
            ends.append(ends[-1][-1] + upto[1:])
            begin = end
        return np.concatenate(ids), np.concatenate(ends)

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """The kind of each code point, as the pre-token pattern sees it."""
        new = points[self.kind[points] == _UNKNOWN]
        for p in np.unique(new).tolist():
            self.kind[p] = next(k for k, kind in enumerate(_KINDS) if kind.match(chr(p)))
        return self.kind[points]

    def _pretokens(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pre-tokens of words, one after another, and how many there are
        before each word. They are runs of one kind, the first with the space
        before it; the pattern itself cuts words with apostrophes or with white
        space behind their first character."""
        raw, bounds = _flat(words)
        begins = np.flatnonzero(raw & 0xC0 != 0x80)
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        kind = self._kinds(points)
        heads = np.searchsorted(begins, bounds[:-1][np.diff(bounds) > 0])
        first = np.zeros(len(points), bool)
        first[heads] = True
        new = first.copy()
        new[1:] |= (kind[1:] != kind[:-1]) & ~(first[:-1] & (points[:-1] == 0x20))
        cut = np.zeros(len(raw) + 1, bool)
        cut[begins[new]] = True
        odd = begins[(points == 0x27) | ((kind == _SPACE) & ~first)]
        for w in distinct(np.searchsorted(bounds, odd, side="right") - 1).tolist():
            begin, end = int(bounds[w]), int(bounds[w + 1])
            cut[begin + 1:end] = False
            for part in PRETOKEN.findall(raw[begin:end].tobytes().decode()):
                cut[begin] = True
                begin += len(part.encode())
        starts = np.append(np.flatnonzero(cut[:-1]), len(raw))
        return _column(raw, starts), np.searchsorted(starts[:-1], bounds)

    def encode_words(self, words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (runs of pre-tokens), joined, and the offsets of each."""
        parts, upto = self._pretokens(words if isinstance(words, pa.Array) else pa.array(words, pa.large_string()))
        coded = parts.dictionary_encode()
        flat, offsets = self._encode_bounded(*_flat(coded.dictionary))
        ids, lens = ragged_take(flat, offsets, coded.indices.to_numpy())
        return ids, np.concatenate([[0], np.cumsum(lens)])[upto]

    def _words(self, cells: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of a column of texts, one after another, and how many
        there are before each text. Words lie side by side in the column's own
        bytes: a word begins with each text, at white space behind a solid
        character and at one behind a single line end or tab. A special token
        is a word; no other word equals one."""
        cells = pc.fill_null(cells.cast(pa.large_string()), "")
        raw, bounds = _flat(cells)
        n = len(raw)
        line = raw - np.uint8(0x09) < 5
        white = line | (raw == 0x20)
        solid = ~(white | (raw - np.uint8(0x1C) < 4))
        for lead, tails in _SPACES.items():
            at = np.flatnonzero(raw == lead)
            tail, size = raw[at + 1].astype(np.int64), 2
            if lead >= 0xE0:
                tail, size = tail << 8 | raw[at + 2], 3
            at = at[np.isin(tail, tails)]
            for k in range(size):
                solid[at + k] = False

        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        cut[1:n] |= white[1:] & solid[:-1]
        cut[1:n] |= line[:-1] & cut[:max(n - 1, 0)] & solid[1:]
        held = np.zeros(len(cells), bool)
        for name in self.special:
            held |= pc.match_substring(cells, name).to_numpy(zero_copy_only=False)
        for base, end in zip(bounds[:-1][held].tolist(), bounds[1:][held].tolist()):
            for m in self.special_re.finditer(raw[base:end].tobytes()):
                cut[base + m.start() + 1:base + m.end()] = False
                cut[[base + m.start(), base + m.end()]] = True
        starts = np.append(np.flatnonzero(cut[:n]), n)
        return _column(raw, starts), np.searchsorted(starts[:-1], bounds)

    def encode_texts(self, chunks: Iterator[tuple[object, list[str] | pa.Array]], keep: int = KEEP_WORDS
                     ) -> Iterator[tuple[object, list[np.ndarray]]]:
        """Ids of each text of each chunk. Words stay encoded from one chunk to
        the next until there are more than ``keep``."""
        known = None
        for tag, texts in chunks:
            if known is None or len(known) > keep:
                known = pa.array(list(self.special), pa.large_string())
                flat = np.array(list(self.special.values()), np.int32)
                offsets = np.arange(len(flat) + 1, dtype=np.int64)
            words, upto = self._words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
            coded = words.dictionary_encode()
            at = pc.index_in(coded.dictionary, value_set=known)
            fresh = coded.dictionary.filter(at.is_null())
            number = pc.fill_null(at, -1).to_numpy().astype(np.int64)
            number[number < 0] = np.arange(len(known), len(known) + len(fresh))
            ids, ends = self.encode_words(fresh)
            known = pa.concat_arrays([known, fresh])
            flat = np.concatenate([flat, ids])
            offsets = np.concatenate([offsets, offsets[-1] + ends[1:]])
            which = number[coded.indices.to_numpy()]
            rows, begin = [], 0
            while begin < len(texts):
                end = max(begin + 1, int(np.searchsorted(upto, upto[begin] + TAKE_WORDS, side="right")) - 1)
                ids, lens = ragged_take(flat, offsets, which[upto[begin]:upto[end]])
                at = np.concatenate([[0], np.cumsum(lens)])[upto[begin:end + 1] - upto[begin]]
                rows += [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                begin = end
            yield tag, rows

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids; bytes that are no UTF-8 become U+FFFD,
        ids outside the vocabulary give nothing."""
        n = len(self.bytes_of)
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist() if i < n]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The vocabulary file at a path that every worker sees; kept per worker."""
    return Tokenizer(path)


def _slices(batches: Iterator[pa.RecordBatch], column: str, size: int | None = None) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches, and their column, with at most ``size``
    (:data:`CHUNK_CHARS`) bytes of text, a longer single text alone."""
    for batch in batches:
        cells = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(cells), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(cells):
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + (size or CHUNK_CHARS), side="right")))
            part = batch.slice(begin, end - begin)
            yield part, part.column(column)
            begin = end


def _chunks(batches: Iterator[pa.RecordBatch], column: str, size: int | None = None) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """:func:`_slices` with the texts as strings, empty for null."""
    for part, cells in _slices(batches, column, size):
        yield part, ["" if t is None else t for t in cells.to_pylist()]


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind, True)])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the BPE ids of each whole text, as the vocabulary file's own
    library encodes it with added special tokens off (their strings inside a
    text are those tokens). Null and empty texts give no ids (empty binary).
    Rows, repeated or not, are encoded one by one; other columns pass through
    and a column already called ``ids`` is replaced.
    """
    df = without(df, ids)
    schema = _extended(df, ids, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in tokenizer(path).encode_texts(_slices(batches, text)):
            packed = pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed], [*batch.schema.names, ids])

    return df.mapInArrow(frugal(run), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of each sequence of ids, special tokens shown.
    Null ids give an empty text; a column already called so is replaced."""
    df = without(df, text)
    schema = _extended(df, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in (b.slice(k, DECODE_ROWS) for b in batches for k in range(0, b.num_rows, DECODE_ROWS)):
            rows = batch.column(ids)
            out = [t.decode(np.frombuffer(r.as_buffer(), "<u4")) if r.is_valid else "" for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             [*batch.schema.names, text])

    return df.mapInArrow(frugal(run), schema)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """:func:`encode` and :func:`decode` in one Python stage, so that a task
    holds the vocabulary once; the same columns, rules and edge cases."""
    df = without(df, ids, decoded)
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.BinaryType(), True), T.StructField(decoded, T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch, rows in t.encode_texts(_slices(batches, text)):
            packed = pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())
            texts = pa.array([t.decode(r) for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, texts], [*batch.schema.names, ids, decoded])

    return df.mapInArrow(frugal(run), schema)

"""Quality rules by line sequence labelling.

A linear-chain conditional random field marks every line of a document as
content or boilerplate; the share of words in content lines decides whether a
document stays. Base rules on counts of the whole text come first.

The field is trained here, by maximum likelihood, on a bounded number of
labelled documents whose lines take the document's label; every whole text is
then labelled with it by Viterbi decoding, one document at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, frugal, without

#: Labelled documents of each class, and lines of a document, that the fit takes at most.
FIT_DOCS = 600
FIT_LINES = 120
#: A document stays if at least this share of its words is in content lines.
MIN_CONTENT = 0.5
#: Base rules: least words, and most per cent of words in repeated windows.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

SYMBOLS = b"#*$%&|<>"
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_DIGITS = re.compile(r"\d")
_UPPER = re.compile(r"[^\W\d_]")

FEATURES = ("bias", "short", "words", "symbol_share", "symbol_words", "repeat_share", "same_neighbours",
            "digit_share", "upper_share", "long_words", "ends_sentence", "seen_line")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in
    the text, the first included. Windows are compared whole: each is numbered
    by joining the numbers of its parts, never by a hash."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    gram = one[:n]
    for k in range(1, window):
        _, gram = np.unique(gram * len(number) + one[k:n + k], return_inverse=True)
    twice = np.bincount(gram)[gram] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").strip()]
    return (len(words), len(text) - len(_SPACE.findall(text)), symbols, len(lines) - len(set(lines)),
            repeated_words(words))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with a word, in [0, 1], and its number of words."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        n = len(words)
        if not n:
            continue
        chars = sum(map(len, words))
        symbols = sum(map(line.count, "#*$%&|<>"))
        letters = len(_UPPER.findall(line)) or 1
        marked = sum(1 for w in words if w[-1] in SYMBOLS)
        equal = sum(map(bytes.__eq__, words, words[1:]))
        rows.append((1.0, 1.0 if n < 4 else 0.0, min(n, 60) / 60, min(1.0, 5 * symbols / chars), marked / n,
                     1 - len(set(words)) / n, min(1.0, 2 * equal / n), len(_DIGITS.findall(line)) / chars,
                     sum(map(str.isupper, line)) / letters, min(1.0, chars / n / 20),
                     1.0 if words[-1][-1:] in (b".", b"?", b"!") else 0.0, 1.0 if line in seen else 0.0))
        sizes.append(n)
        seen.add(line)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


@dataclass(frozen=True)
class LineField:
    """A linear-chain field over two labels, 0 content and 1 boilerplate."""

    weights: np.ndarray  # label x feature
    moves: np.ndarray  # label x next label

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels; content on a tie."""
        n = len(features)
        if not n:
            return np.zeros(0, np.int64)
        emit = (features @ self.weights.T).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = emit[0]
        back = []
        for e0, e1 in emit[1:]:
            x0, x1, y0, y1 = a + m00, b + m10, a + m01, b + m11
            back.append((0 if x0 >= x1 else 1, 0 if y0 >= y1 else 1))
            a, b = e0 + (x0 if x0 >= x1 else x1), e1 + (y0 if y0 >= y1 else y1)
        label = 0 if a >= b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1], np.int64)

    def content_share(self, features: np.ndarray, sizes: np.ndarray) -> float:
        """Share of words in content lines; 0 for a text without words."""
        total = int(sizes.sum())
        return float(sizes[self.viterbi(features) == 0].sum()) / total if total else 0.0


def _log_add(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=-1, keepdims=True)))[..., 0]


def fit_field(docs: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.2,
              ridge: float = 1e-3) -> LineField:
    """Maximum likelihood with a ridge penalty by full-batch Adam steps.
    ``docs``: line features and label of each document. Both labels weigh the
    same. Without documents of both labels every line is content."""
    docs = [(x, y) for x, y in docs if len(x)]
    dim = len(FEATURES)
    if len({y for _, y in docs}) < 2:
        weights = np.zeros((2, dim))
        weights[0, 0] = 1.0
        return LineField(weights, np.zeros((2, 2)))
    docs.sort(key=lambda d: -len(d[0]))
    lens = np.array([len(x) for x, _ in docs])
    y = np.array([label for _, label in docs])
    share = np.bincount(y, minlength=2)
    cost = (0.5 / share)[y] / lens  # each document and each label alike
    x = np.zeros((len(docs), lens[0], dim))
    for k, (rows, _) in enumerate(docs):
        x[k, :len(rows)] = rows
    live = [int((lens > t).sum()) for t in range(lens[0])]
    own = np.zeros((2, dim))
    for label in (0, 1):
        own[label] = (x[y == label].sum(axis=1) * cost[y == label, None]).sum(axis=0)
    own_moves = np.zeros((2, 2))
    for label in (0, 1):
        own_moves[label, label] = ((lens[y == label] - 1) * cost[y == label]).sum()
    theta = np.zeros(2 * dim + 4)
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, m = theta[:2 * dim].reshape(2, dim), theta[2 * dim:].reshape(2, 2)
        emit = x @ w.T
        forward = np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for t in range(1, lens[0]):
            k = live[t]
            forward[:k, t] = emit[:k, t] + _log_add(forward[:k, t - 1, None, :] + m.T[None])
        z = _log_add(forward[np.arange(len(docs)), lens - 1])
        backward = np.zeros_like(emit)
        moves = np.zeros((2, 2))
        for t in range(lens[0] - 2, -1, -1):
            k = live[t + 1]
            nxt = emit[:k, t + 1] + backward[:k, t + 1]
            backward[:k, t] = _log_add(m[None] + nxt[:, None, :])
            both = np.exp(forward[:k, t, :, None] + m[None] + nxt[:, None, :] - z[:k, None, None])
            moves += (both * cost[:k, None, None]).sum(axis=0)
        p = np.exp(forward + backward - z[:, None, None])
        p[np.arange(lens[0])[None, :] >= lens[:, None]] = 0
        expect = np.einsum("ntl,ntd,n->ld", p, x, cost)
        grad = np.concatenate([(own - expect).ravel(), (own_moves - moves).ravel()]) - ridge * theta
        mean = 0.9 * mean + 0.1 * grad
        var = 0.999 * var + 0.001 * grad ** 2
        theta = theta + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.999 ** step)) + 1e-8)
    return LineField(theta[:2 * dim].reshape(2, dim), theta[2 * dim:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality",
          fit_docs: int = FIT_DOCS, fit_lines: int = FIT_LINES) -> LineField:
    """Fit the field on at most ``fit_docs`` documents of each class of at most
    ``fit_lines`` lines each, the first in the order of a hash of their ids,
    of the labelled documents that have a text. A document with both labels
    counts as the lower one. Only these documents' line features come to the
    driver. Without documents of both classes the field keeps every line."""
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    marks = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("__label"))
    # only ids are shuffled, no texts
    with_text = docs.where(F.col(text).isNotNull()).select("doc_id").distinct()
    marks = cut(marks.join(with_text, "doc_id", "left_semi"), "quality-marks")
    ids = None
    for value in (0, 1):
        part = marks.where(F.col("__label") == value).orderBy(mark, "doc_id").limit(fit_docs)
        ids = part if ids is None else ids.unionByName(part)
    # bounded by 2 * fit_docs rows of an id and a label
    rows = docs.select("doc_id", F.col(text).alias("__text")).join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, t, y in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "__text", "__label"))):
                x, _ = line_features(t or "")
                if 0 < len(x) <= fit_lines:
                    found.append((str(i), 1 - int(y), x.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()),
                 pa.array([f[2] for f in found], pa.binary())], ["doc_id", "label", "features"])

    got = rows.mapInArrow(frugal(run), "doc_id string, label int, features binary").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    return fit_field([(np.frombuffer(bytes(r["features"]), "<f4").reshape(-1, len(FEATURES)).astype(float),
                       r["label"]) for r in got])


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share",
         "kept")


def judge(docs: DataFrame, field: LineField, text: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """Add the counts, ``base_failed``, ``content_share`` and ``kept`` to every
    document, from its whole text.

    Null texts count as empty: no words, ``base_failed``. Repeated rows are
    judged alike, extra columns pass through and columns with the names that
    are added are replaced. An empty table stays empty.
    """
    df = without(docs, *ADDED)
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, k, True) for n, k in zip(ADDED, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in ADDED]
            for cell in batch.column(text):
                t = cell.as_py() or ""
                counts = base_counts(t)
                failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
                share = field.content_share(*line_features(t))
                for column, v in zip(out, (*counts, failed, share, not failed and share >= min_content)):
                    column.append(v)
            arrays = [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *ADDED])

    return df.mapInArrow(frugal(run), schema)

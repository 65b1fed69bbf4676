"""Toxic passages by maximum-scoring segments.

Every token has a log-odds score between the toxic and the clean labelled
texts, smoothed by Dirichlet priors: a word's prior is the log-odds of its
first letters, so a word that training never saw still has the score of its
stem. All significant words form a lexicon; the rest share one, slightly
negative score. The Ruzzo-Tompa scan finds all maximal scoring segments of a
text in linear time. As the scores are log-likelihood ratios, a segment of
score S turns up by chance about ``K * n * exp(-S)`` times in n tokens; the
segments that beat their text's length are summed, and the extreme-value
distribution turns the sum into a score between 0 and 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, frugal, without

#: Lengths of the stems that words fall back on.
STEMS = (4, 5)
#: Weight of a prior, in texts; toxic texts that an entry needs at least, and
#: its least likelihood-ratio statistic (chi-square, one degree of freedom);
#: entries of the model at most, the most significant ones.
PRIOR = 1.0
MIN_COUNT = 3
MIN_G2 = 12.0
LEXICON = 20_000
#: Labelled documents of each class that the fit takes at most.
FIT_DOCS = 10_000
#: Largest log-odds of one word.
CAP = 6.0
#: Scale of the extreme-value distribution. Theory has 1 for independent
#: tokens; those of a text are not, and a wider one keeps far scores apart.
SCALE = 4.0
#: A score of at least this predicts toxic.
THRESHOLD = 0.3
#: Width of a bin of the calibration's histogram.
BIN = 0.1

_TOKEN = re.compile(r"\w+")
_STEM = "\0"  # marks a lexicon entry for a stem: no token holds it


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def items(word: str) -> list[str]:
    """The word's entries from the shortest stem to the word itself."""
    return [_STEM + word[:n] for n in STEMS if len(word) > n] + [word]


def segments(scores: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa) of a sequence given as
    runs ``(begin, end, score)``, as ``(begin, end, score)``, in order. One
    pass; the segments kept so far are a stack whose left sums only grow."""
    total = 0.0
    stack: list[list[float]] = []  # begin, end, sum before, sum at its end
    for begin, end, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        new = [begin, end, before, total]
        while True:
            at = len(stack) - 1
            while at >= 0 and stack[at][2] >= new[2]:
                at -= 1
            if at < 0 or stack[at][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[at][0], new[1], stack[at][2], new[3]]
            del stack[at:]
    return [(int(b), int(e), right - left) for b, e, left, right in stack]


@dataclass
class Toxicity:
    """The trained model: entries with their log-odds, the score of all other
    tokens, and the Karlin-Altschul constant K (as its logarithm)."""

    lexicon: dict[str, float]
    other: float
    log_k: float = 0.0
    base_tokens: float = 50.0
    _seen: dict[str, float] = field(default_factory=dict, repr=False)

    def score_of(self, word: str) -> float:
        got = self._seen.get(word)
        if got is None:
            got = next((self.lexicon[k] for k in reversed(items(word)) if k in self.lexicon), 0.0)
            if len(self._seen) > 200_000:
                self._seen.clear()
            self._seen[word] = got
        return got

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal segments of a text as token ranges, and its number of tokens."""
        words = tokens(text)
        score = self.score_of
        runs, last = [], 0
        for k, s in enumerate(map(score, words)):
            if s > 0:
                if k > last:
                    runs.append((last, k, self.other * (k - last)))
                runs.append((k, k + 1, s))
                last = k + 1
        return segments(runs), len(words)

    def evidence(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum of what the segments score above the logarithm of the text's
        search space (the best segment's negative distance if none does), and
        the segments that score above it."""
        found, n = self.passages(text)
        need = math.log(n + self.base_tokens)
        above = [s - need for _, _, s in found]
        total = sum(x for x in above if x > 0) or max(above, default=-need)
        return total, [x for x in found if x[2] > need]

    def score(self, evidence: float) -> float:
        """Probability that chance alone stays below this evidence."""
        return math.exp(-math.exp(min(6.0, (self.log_k - evidence) / SCALE)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, text: str = "text", fit_docs: int = FIT_DOCS
             ) -> tuple[DataFrame, dict[int, float]]:
    """Training rows ``text, toxic``, and how many labelled documents each of
    a class's rows stands for. They are the labelled documents with a text
    that aren't held out, of each class at most ``fit_docs``, the first in the
    order of a hash of their ids. A document with conflicting labels counts as
    toxic; exact copies count once."""
    marks = (labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(~held_out(F.col("doc_id"))))
    # only ids are shuffled, no texts
    with_text = docs.where(F.col(text).isNotNull()).select("doc_id").distinct()
    marks = cut(marks.join(with_text, "doc_id", "left_semi"), "toxicity-marks")
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    ids = None
    for value in (0, 1):
        part = marks.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
        ids = part if ids is None else ids.unionByName(part)
    # bounded by 2 * fit_docs rows of an id and a label
    rows = (docs.select("doc_id", F.col(text).alias("text")).where("text is not null")
            .join(F.broadcast(ids), "doc_id").select("text", "toxic").distinct())
    return cut(rows, "toxicity-rows"), {k: max(1.0, n / fit_docs) for k, n in totals.items()}


def _count_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[int(toxic)].update(set(tokens(text)))
        totals: dict[str, list[int]] = {}
        for label, words in enumerate(counts):
            for word, n in words.items():
                for item in items(word):
                    totals.setdefault(item, [0, 0])[label] += n
            totals.setdefault("", [0, 0])[label] += sum(words.values())  # all tokens
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array([v[0] for v in totals.values()], pa.int64()),
             pa.array([v[1] for v in totals.values()], pa.int64())], ["item", "clean", "toxic"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", lexicon: int = LEXICON,
          fit_docs: int = FIT_DOCS) -> Toxicity:
    """Count the training texts that hold a word, keep the significant entries
    and calibrate. Counts are summed per task before they are shuffled; only
    the lexicon's entries and a histogram come to the driver. Without training
    rows of both labels the model knows no toxic word.
    """
    rows, stands_for = labelled(docs, labels, text, fit_docs)
    counts = (rows.mapInArrow(frugal(_count_items), "item string, clean long, toxic long")
              .groupBy("item").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    # only entries whose share among toxic texts is significantly higher leave
    # the executors, and of these a bounded number
    counts = cut(counts, "toxicity-counts")
    total = counts.where("item = ''").collect()
    n0, n1 = (total[0]["clean"], total[0]["toxic"]) if total else (0, 0)
    if not n0 or not n1:
        return Toxicity({}, -1e-3, log_k=50.0)
    n = F.col("toxic") + F.col("clean")
    g2 = 2 * (F.col("toxic") * F.log(F.col("toxic") * (n0 + n1) / (n * n1))
              + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") * (n0 + n1) / (n * n0)))
              .otherwise(0.0))
    more = F.col("toxic") * F.lit(float(n0)) > F.col("clean") * F.lit(float(n1))
    top = (counts.where((F.col("item") != "") & (F.col("toxic") >= MIN_COUNT)).withColumn("g2", g2)
           .where(more & (F.col("g2") >= MIN_G2)).orderBy(F.desc("g2"), "item").limit(lexicon).collect())
    if not top:
        return Toxicity({}, -1e-3, log_k=50.0)
    found = {r["item"]: (r["clean"] / n0, r["toxic"] / n1, r["clean"], r["toxic"]) for r in top}
    model: dict[str, float] = {}
    for item in sorted(found, key=lambda s: (not s.startswith(_STEM), len(s), s)):
        clean, toxic, k0, k1 = found[item]
        parents = ([_STEM + item[1:1 + n] for n in STEMS if len(item) - 1 > n] if item.startswith(_STEM)
                   else items(item)[:-1])
        prior = next((model[p] for p in reversed(parents) if p in model), 0.0)
        share = 1 / (1 + math.exp(-prior))
        unit = (clean + toxic) / (k0 + k1)  # what one word adds to a rate
        odds = math.log((toxic + PRIOR * unit * share) / (clean + PRIOR * unit * (1 - share)))
        if odds > 0:
            model[item] = min(CAP, odds)
    words = [(c, t) for k, (c, t, _, _) in found.items() if not k.startswith(_STEM) and k in model]
    mass0, mass1 = min(0.9, sum(c for c, _ in words)), min(0.9, sum(t for _, t in words))
    other = min(-1e-3, math.log((1 - mass1) / (1 - mass0)))
    return calibrate(Toxicity(model, other), rows, stands_for)


def calibrate(model: Toxicity, rows: DataFrame, stands_for: dict[int, float]) -> Toxicity:
    """Set K so that the threshold's score falls where F1 is best, from a
    histogram of the training rows' evidence, each row weighing as many
    labelled documents as it stands for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = Counter((max(-400, min(400, math.floor(model.evidence(t)[0] / BIN))), int(y)) for t, y in
                           zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in bins], pa.int32()), pa.array([k[1] for k in bins], pa.int32()),
                 pa.array(list(bins.values()), pa.int64())], ["bin", "toxic", "n"])

    got = (rows.mapInArrow(frugal(run), "bin int, toxic int, n long").groupBy("bin", "toxic").agg(F.sum("n").alias("n"))
           .collect())
    hist = np.zeros((802, 2))
    for r in got:
        hist[r["bin"] + 400, r["toxic"]] += r["n"] * stands_for.get(r["toxic"], 1.0)
    above = hist[::-1].cumsum(axis=0)[::-1]
    f1 = 2 * above[:, 1] / np.maximum(above.sum(axis=1) + hist[:, 1].sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    cut = (float(best[0] + best[-1]) / 2 - 400) * BIN  # the middle of the best range
    return Toxicity(model.lexicon, model.other, cut + SCALE * math.log(-math.log(THRESHOLD)), model.base_tokens)


ADDED = ("score", "predicted", "passages")


def score(docs: DataFrame, model: Toxicity, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on) and
    ``passages`` (token ranges and scores of the segments that beat their
    text's length) to every document, from its whole text alone.

    Null texts count as empty; an empty text has the score of no evidence.
    Repeated rows score alike, extra columns pass through, columns with the
    added names are replaced, and an empty table stays empty.
    """
    df = without(docs, *ADDED)
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("passages", T.ArrayType(T.StructType([
                               T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
                               T.StructField("score", T.DoubleType())])))])
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for cell in batch.column(text):
                evidence, found = model.evidence(cell.as_py() or "")
                scores.append(model.score(evidence))
                spans.append([{"begin": b, "end": e, "score": s} for b, e, s in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(spans, kind)],
                [*batch.schema.names, *ADDED])

    return df.mapInArrow(frugal(run), schema)

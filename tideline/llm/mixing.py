"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, repeated up to
``max_repeats`` times. A document's virtual finish time is the number of words
its source has served when it is done, divided by the source's target. All
entries are range-sorted by finish time into one sequence, which is cut at the
total budget; a document in service at the cut gives the part it has served,
so sources end at their targets, not one document beside them.

Running totals are taken in chunks of bounded size (a source's chunks are
ranges of the shuffle key, the sequence's are ranges of finish time), so
neither a hot source nor the whole sequence meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, n_words, running_totals

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and how often a document may be taken.
BUDGET = 1.5
MAX_REPEATS = 2
#: Rows that a running-total chunk holds on average.
CHUNK_ROWS = 4096


def shuffle_key(doc_id: Column, seed: str) -> Column:
    """Hex digest by which a source's documents are shuffled: the same at any
    partitioning and on any rerun."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, n, source_size`` -> the same plus ``weight`` and ``target``.

    The budget is shared by weight; a target stops at ``max_repeats`` times the
    source's size and the excess is shared again among the others until none
    is above. That is one level ``t`` with ``target = min(cap, weight * t)``,
    found by going through the sources in the order in which they fill up. The
    frame has one row per source and is ordered in one task, as their ranks
    need; it holds no documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name)
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                                (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    s = (s.withColumn("__cap", F.col("source_size") * max_repeats)
         .withColumn("__full", F.col("__cap") / F.col("weight")))
    fill = Window.orderBy("__full", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("__level",
                     (F.sum("source_size").over(whole) * F.lit(float(budget))
                      - F.coalesce(F.sum("__cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
    s = s.withColumn("__t", F.max(F.when(F.col("__level") <= F.col("__full"), F.col("__level"))).over(whole))
    target = F.least(F.col("__cap").cast("double"), F.col("weight") * F.col("__t"))
    return s.select("source", "n", "source_size", "weight",
                    F.coalesce(target, F.col("__cap").cast("double")).alias("target"))


def mix(docs: DataFrame, text: str = "text", seed: str = "mix", weights=WEIGHTS,
        budget: float = BUDGET, max_repeats: int = MAX_REPEATS, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (``doc_id, source, text``): two frames.

    * entries, one row per document and turn that the mix takes: ``row`` (a
      number of the document's row, or the column of that name), ``doc_id, source, turn`` (0, 1, ...),
      ``finish`` (virtual finish time), ``position`` (words of the sequence
      before it) and ``words`` (that it gives; less than its size only where
      the budget ends);
    * documents, one row per row of ``docs``: ``row, doc_id, source, size,
      source_size, weight, target``.

    Null texts have no words; a document without words is in the second frame
    only. Null sources are one source, named last. Null ids and repeated rows
    are documents like any others; rows equal in id, source and size share a
    shuffle key and stand in the order of ``row``. An empty table gives empty
    frames. Columns other than the three are not looked at.
    """
    slim = docs.select("doc_id", "source", n_words(F.col(text)).alias("size"), *([F.col(row).alias("row")] if row else []))
    if row is None:
        same = Window.partitionBy("doc_id", "source", "size").orderBy("size")
        slim = slim.withColumn("row", F.row_number().over(same))
    slim = cut(slim, "mix-docs")
    sizes = slim.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    src = targets(sizes, weights, budget, max_repeats)
    src = src.withColumn("__source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    src = cut(src, "mix-sources")
    docs_out = (slim.withColumn("__source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
                .join(src.drop("source"), "__source"))
    key = shuffle_key(F.col("doc_id"), seed)
    at = F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    keyed = docs_out.where("size > 0").select(
        "__source", "doc_id", "source", "row", "size", "source_size", "target", key.alias("__key"),
        F.floor(at * F.ceil(F.col("n") / CHUNK_ROWS)).cast("bigint").alias("__chunk"))
    started = running_totals(keyed, ["__source"], "__chunk", ["__key", "doc_id", "size", "row"], "size", "start")
    turns = started.withColumn("turn", F.explode(F.array(*[F.lit(i) for i in range(max_repeats)])))
    first = F.col("start") + F.col("turn") * F.col("source_size")
    limit = F.floor(F.col("target") + 0.5).cast("bigint")
    served = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), limit - first))
    entries = (turns.withColumn("served", served).where("served > 0")
               .withColumn("finish", (first + F.col("served")) / F.col("target"))
               .select("__source", "doc_id", "source", "row", "size", "turn", "finish", "served", "__key"))
    entries = cut(entries, "mix-entries")
    total = entries.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    all_words = src.agg(F.sum("source_size").alias("s")).collect()[0]["s"] or 0
    limit_words = int(all_words * budget)
    chunks = max(1, -(-total // CHUNK_ROWS))
    ordered = running_totals(
        entries.withColumn("__at", F.floor(F.col("finish") * F.lit(float(chunks))).cast("bigint")),
        [], "__at", ["finish", "__source", "turn", "__key", "doc_id", "size", "row"], "served", "position")
    words = F.least(F.col("served"), F.lit(limit_words) - F.col("position"))
    entries = (ordered.withColumn("words", words).where("words > 0")
               .select("row", "doc_id", "source", "size", "turn", "finish", "position", "words"))
    return entries, docs_out.drop("__source", "n")


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target`` (its
    source's) and ``taken``, the words that the mix takes of it, repeats counted."""
    entries, rows = mix(docs, **options)
    got = entries.groupBy("doc_id", "source", "size", "row").agg(F.sum("words").alias("taken"))
    a, b = rows.alias("a"), got.alias("b")
    both = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.source").eqNullSafe(F.col("b.source"))
                  & (F.col("a.size") == F.col("b.size")) & (F.col("a.row") == F.col("b.row")), "left")
    return both.select("a.doc_id", "a.size", "a.source_size", "a.target",
                       F.coalesce("b.taken", F.lit(0)).cast("bigint").alias("taken"))


def apply_mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixed documents, whole, with the columns of ``docs``: a document
    taken twice is there twice. Where a target or the budget ends inside a
    document, it is there if at least half of it was to be taken: each source
    ends at the document whose end is nearer to its target. The rows are
    range-sorted into the order of the mix; only this sort and the join with
    the mix move texts."""
    numbered = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-texts")
    entries, _ = mix(numbered, text, row="__row", **options)
    chosen = entries.where(2 * F.col("words") >= F.col("size")).select(F.col("row").alias("__row"), F.col("position").alias("__at"))
    return numbered.join(chosen, "__row").orderBy("__at").select(*[F.col(f"`{c}`") for c in docs.columns])

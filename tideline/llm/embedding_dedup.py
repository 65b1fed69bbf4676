"""Near-duplicate embeddings by collision-counting projections.

Vectors are normalised, so a least cosine is a greatest distance. Each is
projected on many random directions; two vectors collide in a direction if
their projections lie within a window of each other, centred on either. The
number of collisions of a pair at the greatest distance is binomial, which
gives the count that such a pair reaches but for a stated probability: pairs
with that count are verified by their exact cosine.

The first direction is a unit vector. Vectors are sorted by it and cut into
blocks of bounded size, and two blocks meet only if their ranges come within
the greatest distance (a projection never lengthens a difference, so this
loses nothing). Collisions are counted block against block in arrays; what
leaves a task is one row per vector, not one per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, running_totals
from .components import components

COSINE = 0.93
#: Random directions, half a window in units of the greatest distance, and the
#: probability that a pair at the greatest distance misses the count.
DIRECTIONS = 96
WINDOW = 1.0
MISS = 1e-5
#: Vectors of a block: two blocks are all that a task holds.
BLOCK = 1024
SEED = 20_240_601


def least_count(directions: int = DIRECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The greatest count that a pair at the greatest distance falls short of
    with probability ``miss`` at most. A difference of length d projects to a
    normal variable of deviation d on a Gaussian direction."""
    p = math.erf(window / math.sqrt(2))
    below = 0.0
    for c in range(directions + 1):
        below += math.comb(directions, c) * p ** c * (1 - p) ** (directions - c)
        if below > miss:
            return c
    return directions


def random_directions(dim: int, directions: int = DIRECTIONS) -> tuple[np.ndarray, np.ndarray]:
    """The unit direction by which vectors are sorted, and Gaussian ones."""
    rng = np.random.default_rng([SEED, dim])
    first = rng.standard_normal(dim)
    return first / np.linalg.norm(first), rng.standard_normal((dim, directions))


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised bytes and the sorting projection of the vectors that can be
    compared: not null or empty, every component finite, not all zero."""
    for batch in batches:
        vectors = batch.column("embedding")
        raw, dims, sort = [], [], []
        for cell in vectors:
            v = cell.values.to_numpy(zero_copy_only=False).astype(np.float64) if cell.is_valid else np.zeros(0)
            top = np.abs(v).max() if len(v) else 0.0
            if not len(v) or not np.isfinite(top) or top == 0:
                raw.append(None), dims.append(None), sort.append(None)
                continue
            raw.append((v + 0.0).tobytes())  # -0.0 becomes 0.0
            dims.append(len(v))
            u = v / top
            sort.append(float(u @ random_directions(len(v), 0)[0] / np.linalg.norm(u)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(raw, pa.binary()),
             pa.array(sort, pa.float64())], ["vec_id", "label", "dim", "raw", "sort"])


def _unit(raw: list) -> np.ndarray:
    v = np.stack([np.frombuffer(r, np.float64) for r in raw])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def collisions(a: np.ndarray, b: np.ndarray, window: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in a, places in b) of projections, ``n x directions``,
    that lie within the window, centred on the first, in at least ``least``
    directions. Counts are held for the pairs of these two blocks alone."""
    count = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.uint16)
    for x, y in zip(a.T, b.T):
        count += np.abs(x[:, None] - y[None, :]) <= window
    return np.nonzero(count >= least)


def link_blocks(a: pa.Table, b: pa.Table, same: bool, least: float, directions: int = DIRECTIONS) -> dict[str, list]:
    """Links between the vectors of two blocks (of one, if ``same``): for each
    linked vector the rows on its other ends and the smallest id that links
    within these blocks lead to."""
    ids = [np.asarray(t.column("rep").to_numpy()) for t in (a, b)]
    times = [np.asarray(t.column("n").to_numpy()) for t in (a, b)]
    u, v = (_unit(t.column("raw").to_pylist()) for t in (a, b))
    _, gauss = random_directions(u.shape[1], directions)
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    i, j = collisions((u @ gauss).astype(np.float32), (v @ gauss).astype(np.float32),
                      WINDOW * reach * (1 + 1e-5) + 1e-6, least_count(directions))
    if same:
        i, j = i[i < j], j[i < j]
    near = np.concatenate([np.einsum("nd,nd->n", u[i[k:k + 65536]], v[j[k:k + 65536]]) >= least
                           for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
    i, j = i[near], j[near]
    n = len(u)
    node = np.concatenate([ids[0], ids[1]])
    j_at = j if same else j + n
    links = np.zeros(len(node), np.int64)
    np.add.at(links, i, times[1][j])
    np.add.at(links, j_at, times[0][i])
    root = np.argsort(np.argsort(node, kind="stable"), kind="stable")  # rank of the id
    order = np.argsort(node, kind="stable")
    while True:  # hook both ends of every link to the smaller rank, then jump
        before = root.copy()
        low = np.minimum(root[i], root[j_at])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j_at, low)
        root = np.minimum(root, root[order[root]])
        if np.array_equal(root, before):
            break
    linked = np.flatnonzero(links)
    return {"rep": node[linked].tolist(), "links": links[linked].tolist(), "root": node[order[root[linked]]].tolist()}


def near_duplicates(vectors: DataFrame, least: float = COSINE, directions: int = DIRECTIONS,
                    block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of
    ``vec_id, embedding, label``.

    Vectors of equal, non-null labels and equal length link if their cosine in
    double precision is at least ``least``. ``n_links`` counts the other
    vectors linked directly, ``component_id`` is the smallest id that links
    lead to, and ``kept`` says that it is the vector's own.

    Null, empty and all-zero vectors, vectors with a null or non-finite
    component, and vectors without a label link with nothing: no links, their
    own component. Equal vectors of a label are compared with others once, as
    a class, and link with each other; repeated rows are vectors of their own
    that share an id. Rows with a null id link with nothing and have a null
    component and a null ``kept``. Extra columns are not looked at; an empty
    table gives no rows. Ids are longs.
    """
    rows = cut(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
                              F.col("embedding").cast("array<double>").alias("embedding"))
               .mapInArrow(_prepare, "vec_id bigint, label string, dim int, raw binary, sort double"), "vectors")
    usable = rows.where("vec_id is not null and label is not null and raw is not null")
    key = ["label", "dim", "digest"]
    usable = usable.withColumn("digest", F.sha2("raw", 256))
    classes = cut(usable.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"),
                                           F.first("raw").alias("raw"), F.first("sort").alias("sort")), "vector-classes")
    per_label = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("__n"))
    spread = (classes.join(per_label, ["label", "dim"])
              .withColumn("__chunk", F.floor((F.col("sort") + 1.0) / 2 * F.ceil(F.col("__n") / 4096)).cast("bigint"))
              .withColumn("__one", F.lit(1).cast("bigint")))
    ranked = running_totals(spread.select("label", "dim", "rep", "sort", "__chunk", "__one"), ["label", "dim"],
                            "__chunk", ["sort", "rep"], "__one", "rank")
    blocks = cut(classes.join(ranked.select("rep", F.expr(f"rank div {block}").alias("block")), "rep")
                 .select("label", "dim", "block", "rep", "n", "raw", "sort"), "vector-blocks")
    ranges = blocks.groupBy("label", "dim", "block").agg(F.min("sort").alias("lo"), F.max("sort").alias("hi"))
    ranges = cut(ranges, "vector-ranges")
    reach = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    a, b = ranges.alias("a"), ranges.alias("b")
    meet = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
                  & (F.col("a.block") <= F.col("b.block")) & (F.col("b.lo") - F.col("a.hi") <= reach))
    meet = meet.select(F.col("a.label").alias("label"), F.col("a.dim").alias("dim"), F.col("a.block").alias("left"),
                       F.col("b.block").alias("right"))
    side = ["label", "dim", "left", "right"]
    body = ["rep", "n", "raw"]
    lefts = blocks.withColumnRenamed("block", "left").join(meet, ["label", "dim", "left"]).select(*side, *body)
    rights = blocks.withColumnRenamed("block", "right").join(meet, ["label", "dim", "right"])
    rights = rights.select(*[F.col(c).alias("r_" + c) for c in side], *[F.col(c).alias(c) for c in body])

    def run(k: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        out = link_blocks(x, y, k[2].as_py() == k[3].as_py(), least, directions)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = cut(lefts.groupBy(*side).cogroup(rights.groupBy(*["r_" + c for c in side])).applyInArrow(
        run, "rep bigint, links bigint, root bigint"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (classes.select(*key, "rep", "n").join(links, "rep", "left")
             .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = rows.withColumn("digest", F.when(F.col("vec_id").isNotNull(), F.sha2("raw", 256))).join(known, key, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))

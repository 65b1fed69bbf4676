"""Document operators against plain versions, and their edge cases."""

import hashlib
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline.llm import bpe, licenses, line_quality, near_dup, queries, toxicity, training_order

tokenizers = pytest.importorskip("tokenizers")

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def words(n, seed):
    r = random.Random(seed)
    return [r.choice("abcdefgh") + str(r.randrange(10 ** 6)) for _ in range(n)]


# --- BPE (10) ---------------------------------------------------------------

def library():
    return tokenizers.Tokenizer.from_file(queries.BPE_FILE)


def hard_texts():
    r = random.Random(7)
    alphabet = " \n\t  abcdefgh'stredn012345é中🎉½²\x1c\x85\u00a0\u3000.,!"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(400)]
    texts += ["", " ", "\n", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "\0bare x", "a" * 5000, "ab" * 3000,
              " " * 200, "x\n\n \ny", "\0special <|endoftext|>"]
    return texts


def test_bpe_ids_and_text_are_the_librarys():
    lib, own = library(), bpe.Tokenizer(queries.BPE_FILE)
    texts = hard_texts()
    for _, rows in own.encode_texts(iter([(0, texts[:100]), (1, texts[100:])])):
        for text, ids in zip(texts[:100] if _ == 0 else texts[100:], rows):
            want = lib.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want
            assert own.decode(ids) == lib.decode(want, skip_special_tokens=False) == text


def test_bpe_cuts_a_column_by_array_operations(monkeypatch):
    """White space of every kind, in a column with an offset and nulls, over
    chunks that share words; no object is made for a word that stands again."""
    lib, own, r = library(), bpe.Tokenizer(queries.BPE_FILE), random.Random(11)
    bits = [*" \n\t\r\x0b\x1c\x1f\x85\u00a0\u1680\u180e\u2003\u2028\u205f\u3000\ufeffab'é中²7,!\u201c", "<|endoftext|>", "<|endo",
            "ftext|>", "'s", " 're", "\n\n", "  ", "the", " the"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(3000)] + [None, "", "<|endo", "ftext|>"]
    cells = pa.array(["left out", *texts], pa.string()).slice(1)
    chunks = [cells.slice(k, 700) for k in range(0, len(cells), 700)]
    got = [ids.tolist() for _, rows in own.encode_texts(enumerate(chunks), keep=1500) for ids in rows]
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]

    seen, real = [], own.encode_words

    def counted(words):
        seen.append((len(words), sys.getallocatedblocks()))
        return real(words)

    monkeypatch.setattr(own, "encode_words", counted)
    one = pa.array(["some words stand here again\nand " * 50_000])
    before = sys.getallocatedblocks()
    list(own.encode_texts([(0, one)]))
    assert len(seen) == 1 and seen[0][0] < 12 and seen[0][1] - before < 50_000


def test_bpe_frames(spark):
    docs = docs_of(spark, [None, "", "hello  world", "hello  world"]).withColumn("IDS", F.lit("mine"))
    out = bpe.decode(bpe.encode(docs, queries.BPE_FILE), queries.BPE_FILE)
    assert [c for c in out.columns if c.lower() == "ids"] == ["ids"] and "source" in out.columns
    got = {r.doc_id: (len(r.ids) // 4, r.decoded) for r in out.collect()}
    n = len(library().encode("hello  world", add_special_tokens=False).ids)
    assert got == {0: (0, ""), 1: (0, ""), 2: (n, "hello  world"), 3: (n, "hello  world")}
    assert bpe.encode(docs.where("false"), queries.BPE_FILE).count() == 0
    odd = bytes(np.array([220, 60000, 2 ** 31], "<u4"))
    one = spark.createDataFrame([(odd,), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(one, queries.BPE_FILE).collect()] == [" ", ""]


def test_op10_on_all_documents(spark):
    lib = library()
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF_SMALL, "documents").collect()}
    got = queries.op10_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- quality rules (7) --------------------------------------------------------

def plain_counts(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_quality_counts_match_plain_ones():
    r = random.Random(3)
    for _ in range(200):
        text = "".join(r.choice(["a ", "b ", "é\t", "#", "x\n", "  ", "\x0b", "\x1c", "\u00a0", "ab c d e f "])
                       for _ in range(r.randrange(60)))
        assert line_quality.base_counts(text) == plain_counts(text)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(30):
        field = line_quality.LineField(rng.normal(size=(2, len(line_quality.FEATURES))), rng.normal(size=(2, 2)))
        x = rng.random((6, len(line_quality.FEATURES)))
        emit = x @ field.weights.T

        def score(path):
            return sum(emit[i, p] for i, p in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

        paths = [[(k >> i) & 1 for i in range(6)] for k in range(64)]
        assert score(field.viterbi(x).tolist()) == pytest.approx(max(map(score, paths)))


def test_line_field_gradient_finds_the_labels():
    good = "The reader went home and slept.\nAnother line of plain words follows here."
    junk = "a | b | c\n### $$$ ||| %%%"
    field = line_quality.fit_field([(line_quality.line_features(t)[0], y) for t, y in [(good, 0), (junk, 1)] * 5])
    assert field.content_share(*line_quality.line_features(good)) == 1.0
    assert field.content_share(*line_quality.line_features(junk)) == 0.0
    assert line_quality.fit_field([]).content_share(*line_quality.line_features(junk)) == 1.0
    assert field.content_share(*line_quality.line_features("")) == 0.0


def test_line_field_is_fitted_on_documents_that_are_there(spark):
    """Labels of absent and empty documents take no place in the sample, and
    conflicting or repeated labels are one label."""
    r = random.Random(31)
    prose = [" ".join(r.choice(["river", "stone", "walk", "green", "open"]) for _ in range(12)) + "." for _ in range(40)]
    docs = [(i, "\n".join(r.sample(prose, 4)) if i % 2 else "\n".join(["MENU | LOGIN | 4%"] * 5)) for i in range(40)]
    labels = [(i, i % 2) for i, _ in docs] + [(k, k % 2) for k in range(1000, 3000)] + [(50, 1), (51, 0)]
    labels += [(1, 1), (3, 0)]     # told twice; told both ways
    frame = spark.createDataFrame([*docs, (50, None), (51, None)], "doc_id bigint, text string")
    field = line_quality.train(frame, spark.createDataFrame(labels, "doc_id bigint, quality int"), fit_docs=20)
    judged = {x.doc_id: x.content_share for x in line_quality.judge(frame, field).collect()}
    assert all((judged[i] > 0.5) == bool(i % 2) for i, _ in docs)


def test_quality_edges_and_held_out_rows(spark):
    labels = queries.table(spark, "/root/testdata/sf0.01", "labels")
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    field = line_quality.train(docs, labels, fit_docs=30)  # most labelled rows stay unseen
    out = line_quality.judge(docs, field)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    seen = [(r.kept, marks[r.doc_id]) for r in out.collect() if r.doc_id in marks and not r.base_failed]
    assert sum(k == bool(q) for k, q in seen) / len(seen) > 0.97
    edge = docs_of(spark, [None, "", "one two", "word " * 3000]).withColumn("Kept", F.lit(1))
    got = {r.doc_id: r for r in line_quality.judge(edge, field).collect()}
    assert [got[i].n_words for i in range(4)] == [0, 0, 2, 3000] and all(got[i].base_failed for i in range(4))
    assert not any(got[i].kept for i in range(4))
    assert line_quality.judge(edge.where("false"), field).count() == 0
    empty = line_quality.train(docs, labels.where("false"))
    assert line_quality.judge(docs, empty).where("not base_failed and not kept").count() == 0


# --- toxicity (5) ----------------------------------------------------------------

def best_segments(scores):
    """Maximal scoring segments by definition: the best segment (the shortest,
    first one on a tie), then the same left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores))
                for j in range(i + 1, len(scores) + 1)))
    _, _, _, i, j = best
    return (best_segments(scores[:i]) + [(i, j, best[0])]
            + [(a + j, b + j, s) for a, b, s in best_segments(scores[j:])])


def test_segments_are_the_maximal_ones():
    r = random.Random(5)
    for _ in range(300):
        scores = [r.choice([-5, -3, -2, -1, 1, 2, 4, 7]) + r.random() / 100 for _ in range(r.randrange(14))]
        got = toxicity.segments([(i, i + 1, s) for i, s in enumerate(scores)])
        assert [(b, e) for b, e, _ in got] == [(b, e) for b, e, _ in best_segments(scores)]
        assert all(s == pytest.approx(sum(scores[b:e])) for b, e, s in got)


def test_toxicity_sample_is_drawn_from_documents_with_a_text(spark):
    docs = docs_of(spark, [f"text number {i}" for i in range(80)] + [None] * 40)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id bigint, toxic int")
    there = labels.where("doc_id < 80").where(~toxicity.held_out(F.col("doc_id")))
    totals = {r.toxic: r["count"] for r in there.groupBy("toxic").count().collect()}
    rows, stands_for = toxicity.labelled(docs, labels, fit_docs=10)
    assert {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()} == {0: 10, 1: 10}
    assert stands_for == {k: n / 10 for k, n in totals.items()}


def test_toxicity_held_out_and_edges(spark):
    sf = "/root/testdata/sf0.1"
    docs = queries.table(spark, sf, "documents").select("doc_id", "text")
    labels = queries.table(spark, sf, "labels")
    model = toxicity.train(docs, labels)
    held = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    got = [(r.predicted, r.toxic) for r in toxicity.score(held, model).select("predicted", "toxic").collect()]
    hits = sum(p and t for p, t in got)
    assert hits / sum(t for _, t in got) > 0.85 and hits / sum(p for p, _ in got) > 0.95
    edge = docs_of(spark, [None, "", "ok " * 40_000, "you stupid worthless idiot"]).withColumn("SCORE", F.lit(2))
    rows = {r.doc_id: r for r in toxicity.score(edge, model).collect()}
    assert all(0 <= rows[i].score < 0.3 and rows[i].predicted == 0 for i in range(3))
    assert rows[3].predicted == 1 and rows[3].passages
    assert toxicity.score(edge.where("false"), model).count() == 0
    blank = toxicity.train(docs, labels.where("false"))
    assert toxicity.score(edge, blank).where("predicted = 1").count() == 0


# --- near duplicates (1) ------------------------------------------------------------

def test_signatures_estimate_the_probability_jaccard():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    a, b = items[:45], items[15:]
    wa, wb = rng.integers(1, 5, 45).astype(float), rng.integers(1, 5, 45).astype(float)
    size = 4000
    s = near_dup.signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), np.repeat([0, 1], 45), 2, size)
    order = np.argsort(a), np.argsort(b)
    want = near_dup.similarity(a[order[0]], b[order[1]], wa[order[0]], wb[order[1]])
    plain = sum(1 / sum(max(da.get(j, 0) / da[i], db.get(j, 0) / db[i]) for j in set(da) | set(db))
                for da, db in [(dict(zip(a, wa)), dict(zip(b, wb)))] for i in set(da) & set(db))
    assert want == pytest.approx(plain)
    assert (s[0] == s[1]).mean() == pytest.approx(want, abs=0.04)


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(11)
    texts = [" ".join(words(60, i)) for i in range(12)]
    for i in range(12):  # near copies, chains of them, and exact ones in other spacing and case
        for k in range(4):
            w = texts[i].split()
            for _ in range(k):
                w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
            texts.append(" ".join(w))
        texts.append(texts[i].upper().replace(" ", "\n"))
    texts += [None, "", "", "one two", "one two", "one two three", ("long " + " ".join(words(30, 99)) + " ") * 300]
    docs = docs_of(spark, texts).select("doc_id", "text", F.lit(0).alias("class_id"))
    got = {row.doc_id: row.class_id for row in near_dup.near_duplicates(docs).collect()}
    hashes = near_dup.WordHashes()
    sets = [np.unique(near_dup.shingles(near_dup.text_words(t), hashes), return_counts=True) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_dup.similarity(sets[i][0], sets[j][0], sets[i][1], sets[j][1]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(texts))}
    kept = near_dup.keep_one(docs.unionByName(docs.where("doc_id < 3")).unionByName(
        spark.createDataFrame([(None, "x", 0)], "doc_id bigint, text string, class_id int")))
    assert sorted(row.doc_id for row in kept.where("doc_id is not null").collect()) == sorted(set(map(root, range(len(texts)))))
    assert kept.where("doc_id is null").count() == 1
    assert near_dup.near_duplicates(docs.where("false")).count() == 0


def plain_classes(texts):
    hashes = near_dup.WordHashes()
    sets = [np.unique(near_dup.shingles(near_dup.text_words(t), hashes), return_counts=True) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near_dup.similarity(sets[i][0], sets[j][0], sets[i][1], sets[j][1]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return root


def test_near_copies_inside_a_template_family(spark):
    # texts on one template, 0.76 alike, meet in most buckets; every fourth has a near copy just above 0.8
    template, texts = words(200, 1), []
    for i in range(240):
        own = words(23, 100 + i)
        texts.append(" ".join(template[:90] + own + template[113:]))
        if i % 4 == 0:
            texts.append(" ".join(template[:90] + own[:7] + words(16, 5000 + i) + template[113:]))
    random.Random(3).shuffle(texts)
    want = plain_classes(texts)
    assert len(set(want)) == 240
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("turned", [False, True])
def test_an_id_on_two_texts_is_one_class_in_any_row_order(spark, turned):
    r = random.Random(21)
    a, b = ([f"w{r.randrange(10 ** 6)}" for _ in range(80)] for _ in range(2))
    near = lambda w: [*w[:40], "other", *w[41:]]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(near(a))), (3, " ".join(near(b))), (4, "alone " * 9),
            (7, " ".join(a)), (9, " ".join(b).upper())]
    docs = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id bigint, text string").coalesce(1)
    got = {x.doc_id: x.class_id for x in near_dup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 7: 1, 9: 1}
    kept = sorted((x.doc_id, x.text) for x in near_dup.keep_one(docs).collect())
    assert kept == sorted([rows[0], rows[1], rows[4]])   # no text that is like no other is lost


def test_an_id_links_the_classes_of_its_texts(spark):
    r = random.Random(22)
    a, b = (" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(60)) for _ in range(2))
    docs = spark.createDataFrame([(1, a), (2, b), (5, b), (5, a), (6, b)], "doc_id bigint, text string")
    assert {x.doc_id: x.class_id for x in near_dup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 5: 1, 6: 1}


def test_bpe_round_trip_is_encode_and_decode(spark):
    texts = [None, "", "hello  world\n", "<|endoftext|> 日本 🎉", "x " * 500, "\x00"]
    docs = docs_of(spark, texts).withColumn("decoded", F.lit(1))
    one = bpe.round_trip(docs, queries.BPE_FILE)
    two = bpe.decode(bpe.encode(docs, queries.BPE_FILE), queries.BPE_FILE)
    assert one.columns == two.columns
    key = lambda rows: sorted((r.doc_id, bytes(r.ids), r.decoded) for r in rows)
    assert key(one.collect()) == key(two.collect())


def test_bitmaps_never_hide_what_two_sets_share():
    r = np.random.default_rng(5)
    for n in (1, 5, 60, 500, 5000):
        base = r.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        a, b = (np.unique(np.concatenate([base[: n - n // k], r.integers(0, 1 << 32, n // k, dtype=np.uint64).astype("<u4")]))
                for k in (4, 7))
        alone = sum(int(x).bit_count() for x in (near_dup.bitmap(a).view(np.uint64) & ~near_dup.bitmap(b).view(np.uint64)))
        assert alone <= len(np.setdiff1d(a, b))
        assert n != 60 or alone > 5


def test_candidates_meet_once(spark):
    """Of texts that share many rare shingles each pair is given once and no
    link is missing, also when the shingles' rows are spread over a grid of
    tasks and prefixes are made a few at a time."""
    r = random.Random(23)
    base = r.sample(range(10 ** 6), 60)
    sets = {u: np.array(sorted({*r.sample(base, 58 if u % 2 else 53), *r.sample(range(10 ** 6, 2 * 10 ** 6), 2)}), "<u4")
            for u in range(40)}
    left = spark.createDataFrame([(u, u + 100, u) for u in sets], "unit bigint, rep bigint, component bigint")
    shingle = spark.createDataFrame([(u, bytearray(x.tobytes()), None) for u, x in sets.items()],
                                    "unit bigint, shingles binary, times binary")
    real = near_dup.SHINGLE_ROWS, near_dup.PREFIX_ROWS, near_dup.BEFORE
    found = []
    try:
        for near_dup.SHINGLE_ROWS, near_dup.PREFIX_ROWS, near_dup.BEFORE in (real, (10, 20, 2)):
            found.append(sorted((x.a, x.b, x.a_rep, x.b_rep) for x in near_dup._candidates(left, shingle, 0.8).collect()))
    finally:
        near_dup.SHINGLE_ROWS, near_dup.PREFIX_ROWS, near_dup.BEFORE = real
    pairs = [tuple(sorted(x[:2])) for x in found[0]]
    assert len(pairs) == len(set(pairs)) and {tuple(sorted(x[:2])) for x in found[1]} == set(pairs)
    assert all(x[2:] == (x[0] + 100, x[1] + 100) for f in found for x in f)
    links = {(i, j) for i in sets for j in sets if i < j and near_dup.similarity(sets[i], sets[j]) >= 0.8}
    assert links and links <= set(pairs)


def test_rare_shingles_stay_rare_among_millions(spark, monkeypatch):
    """Sets with enough shingles that no other set has meet nobody, however
    many shingles there are in all, if they share only few with each other."""
    n, alone, common = 3000, 700, 300
    r = np.random.default_rng(31)
    pool = r.permutation(np.repeat(np.arange(n * common // 2), 2)).reshape(n, common)
    sets = [np.unique(np.concatenate([np.arange(u * alone, (u + 1) * alone) + pool.size, pool[u]])).astype("<u4") for u in range(n)]
    left = spark.createDataFrame([(u, u, u) for u in range(n)], "unit bigint, rep bigint, component bigint")
    shingle = spark.createDataFrame([(u, bytearray(x.tobytes()), None) for u, x in enumerate(sets)],
                                    "unit bigint, shingles binary, times binary")
    rows, real = {}, near_dup.cut

    def counted(df, name, *more):
        rows[name] = real(df, name, *more)
        return rows[name]

    monkeypatch.setattr(near_dup, "cut", counted)
    assert near_dup._candidates(left, shingle, 0.8).isEmpty()
    assert rows["near-dup-meeting"].isEmpty()


def test_linked_sets_share_an_item_of_both_prefixes():
    rng, linked = np.random.default_rng(4), 0
    for _ in range(3000):
        base = rng.choice(400, 40, replace=False)
        sets = []
        for _ in range(2):
            own = np.unique(np.concatenate([base[rng.random(40) < 0.95], rng.choice(400, rng.integers(0, 5))])).astype("<u4")
            sets.append((own, rng.integers(1, 4, len(own)) if rng.random() < 0.5 else None))
        (a, wa), (b, wb) = sets
        if near_dup.similarity(a, b, wa, wb) >= 0.8:
            linked += 1
            x, y = (dict(zip(*(v.tolist() for v in near_dup.prefix(s, w, s % 7, 0.8)))) for s, w in sets)
            assert any(x[k] + y[k] <= 2.25 + 1e-9 for k in x.keys() & y.keys())
    assert linked > 100


# --- training order (2) ---------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 65_537])
def test_feistel_is_a_keyed_permutation(n):
    order = training_order.Feistel(n, "a")
    slots = order.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.sequence(slots) == np.arange(n)).all()
    if n >= 1000:
        assert (slots != training_order.Feistel(n, "b").slot(np.arange(n))).mean() > 0.9


def test_shards_do_not_follow_the_splits_of_the_scan(spark, tmp_path):
    """The same two files give the same shards however the scan cuts and deals them."""
    folder = str(tmp_path / "docs")
    texts = [" ".join(words(60, i)) for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartitionByRange(2, "doc_id")
    rows.sortWithinPartitions("doc_id").write.option("parquet.block.size", 8192).parquet(folder)
    found = set()
    sizes = {"spark.sql.files.minPartitionNum": ("1", "4", "16"), "spark.sql.files.maxPartitionBytes": ("134217728", "16384", "9000"),
             "spark.sql.files.openCostInBytes": ("4194304", "1", "1")}
    try:
        for k in range(3):
            for name, values in sizes.items():
                spark.conf.set(name, values[k])
            docs = spark.read.parquet(folder).select("text", "_metadata.file_path", "_metadata.file_block_start")
            manifest = training_order.write_shards(docs, queries.BPE_FILE, str(tmp_path / f"out{k}"), sequence=64, per_shard=16,
                                                   place=("file_path", "file_block_start"))
            found.add((docs.rdd.getNumPartitions(), tuple(sorted((r.shard, r.sha256) for r in manifest.collect()))))
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len({n for n, _ in found}) == 3 and len({shards for _, shards in found}) == 1


def test_the_stream_follows_files_of_any_size(spark, tmp_path):
    """A scan reads large files first; the stream has the first file first."""
    small, large = ["alone " * 4] * 3, [" ".join(words(40, i)) for i in range(300)]
    for name, texts in (("a", small), ("b", large)):
        pq.write_table(pa.table({"text": texts}), tmp_path / f"{name}.parquet")
    docs = spark.read.parquet(str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")).select(
        "text", "_metadata.file_path", "_metadata.file_block_start")
    real = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        n = training_order.write_shards(docs, queries.BPE_FILE, str(tmp_path / "out"), sequence=16, per_shard=8,
                                        place=("file_path", "file_block_start")).agg(F.sum("n_sequences").alias("n")).first()["n"]
    finally:
        for k, v in real.items():
            spark.conf.set(k, v)
    read = training_order.with_sequence(training_order.read_shards(spark, str(tmp_path / "out"), 16, 8), n)
    lib = library()
    want = [i for t in small + large for i in [*lib.encode(t, add_special_tokens=False).ids, 50256]]
    got = [i for r in read.orderBy("sequence").collect() for i in np.frombuffer(r.ids, "<u2").tolist()]
    assert got[:len(want)] == want and len(got) == 16 * n and set(got[len(want):]) <= {50256}


def test_pieces_of_a_range_travel_compressed(spark, tmp_path, monkeypatch):
    """What is dealt to the ranges is less than the ids, and few rows."""
    docs = docs_of(spark, [" ".join(words(300, i)) for i in range(200)]).select("text").coalesce(1)
    dealt, real = [], type(docs).repartitionById

    def seen(self, *args):
        dealt.append(self.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("ids")).alias("bytes")).first())
        return real(self, *args)

    monkeypatch.setattr(type(docs), "repartitionById", seen)
    manifest = training_order.write_shards(docs, queries.BPE_FILE, str(tmp_path / "out"))
    assert dealt[0]["rows"] <= 2 and dealt[0]["bytes"] < 0.85 * manifest.agg(F.sum("n_bytes").alias("n")).first()["n"]


def test_shards_hold_the_stream_in_slot_order(spark, tmp_path):
    texts = [None, "", "hello world. " * 30, "x", "x"] + [" ".join(words(40, i)) for i in range(30)]
    docs = docs_of(spark, texts).coalesce(1).select(F.lit(1).alias("slot"), "text")
    folder = str(tmp_path / "shards")
    manifest = training_order.write_shards(docs, queries.BPE_FILE, folder, sequence=16, per_shard=8).collect()
    lib = library()
    stream = [i for t in texts for i in [*lib.encode(t or "", add_special_tokens=False).ids, 50256]]
    n = -(-len(stream) // 16)
    stream += [50256] * (n * 16 - len(stream))
    order = training_order.Feistel(n)
    want = {int(order.slot(np.array([s]))[0]): stream[16 * s:16 * s + 16] for s in range(n)}
    read = training_order.read_shards(spark, folder, sequence=16, per_shard=8)
    assert {r.slot: np.frombuffer(r.ids, "<u2").tolist() for r in read.collect()} == want
    assert sum(r.n_sequences for r in manifest) == n and {r.first_slot for r in manifest} == set(range(0, n, 8))
    later = training_order.read_shards(spark, folder, 16, 8, from_slot=11).collect()
    assert {r.slot for r in later} == set(range(11, n))
    assert training_order.write_shards(docs.where("false"), queries.BPE_FILE, folder + "2").count() == 0


# --- licences (4) ----------------------------------------------------------------------

def test_license_rules(spark):
    one, two = "Released under the MIT License.", "All rights reserved."
    bsd = dict(licenses.RULES)["BSD-text"]
    texts = [None, "", f"Some text. {one} More.", f"x\n{one}\n{two}", f"{two} {one}",
             f"{bsd[0]} A. B. {bsd[1]}", f"{bsd[0]} A. B. C. D. E. {bsd[1]}", "released UNDER the (mit) license!",
             f"{one} " * 2, f"pre {one}"]
    docs = docs_of(spark, texts)
    got = sorted((r.doc_id, r.licence, r.first, r.last) for r in
                 licenses.scan(docs.unionByName(docs).withColumn("licence", F.lit(0))).collect())
    assert got == [(2, "MIT", 1, 1), (3, "MIT-with-rights", 1, 2), (4, "All-rights-reserved", 0, 0), (4, "MIT", 1, 1),
                   (5, "BSD-text", 0, 3), (7, "MIT", 0, 0), (8, "MIT", 0, 0), (8, "MIT", 1, 1)]
    assert licenses.scan(docs.where("false")).count() == 0


def test_license_sentences_wrapped_over_lines(spark):
    rules = dict(licenses.RULES)
    apache, bsd, mit = rules["Apache-2.0-notice"], rules["BSD-text"], rules["MIT-text"][0]

    def wrapped(sentence, mark=""):
        ws = sentence.split()
        return "\n".join(mark + " ".join(ws[i:i + 8]) for i in range(0, len(ws), 8))

    texts = [f"# Title\n#\n{wrapped(' '.join(apache), '# ')}\n#\n#   http://x", f"Header\n\n{wrapped(mit, ' * ')}\n",
             f"1. {wrapped(bsd[0])}\n2. {wrapped(bsd[1])}\n", f"{bsd[0]} All rights reserved. {bsd[1]}",
             wrapped(mit).replace("\n", "\n\n")]
    got = {(r.doc_id, r.licence) for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert got == {(0, "Apache-2.0-notice"), (1, "MIT-text"), (2, "BSD-text"), (3, "BSD-text")}

"""Chats, URLs, vectors, the mix, components and the pipeline."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from tideline.llm import chat, common, components, embedding_dedup, mixing, queries, url_filter
from tideline.schema import TABLES

# --- chat formatting (6) ------------------------------------------------------------


def test_format_and_parse_are_inverse():
    r = random.Random(4)
    parts = ["\\", "###", "### Assistant: ", "</turn>", "</turn>\n", ":", "é🎉", "a b", "\n", "#", "<", "\\\\"]
    for _ in range(300):
        turns = [("".join(r.choices(parts, k=r.randrange(3))) if r.random() < .3 else r.choice(["user", "assistant"]),
                  "".join(r.choices(parts, k=r.randrange(8))), r.random() < .3) for _ in range(r.randrange(5))]
        text, spans = chat.format_turns(turns)
        assert chat.parse_turns(text) == [(a, b) for a, b, _ in turns]
        assert [chat.unescape(text[b:e]) for b, e in spans] == [
            t for role, t, again in turns if role == "assistant" and not again]


def test_a_very_long_turn_is_parsed_in_linear_memory():
    import resource

    text = "long words \\ < </turn> ### é " * 500_000   # 16 million characters with marks to escape
    formatted, _ = chat.format_turns([("user", text, False)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert chat.parse_turns(formatted) == [("user", text)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000   # kB


def test_a_string_id_is_not_the_missing_id(spark):
    rows = [("null", 0, "user", "a"), (None, 0, "user", "b"), ("", 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    back = {r.conv_id: r.turns_sha256 for r in chat.read_back(chat.windows(df)).collect()}
    assert back == {c: digest([(role, t)])[1] for c, _, role, t in rows}


def conversation(n, length=40, system=True):
    turns = [("system", "be kind " * 5)] if system else []
    turns += [("user" if i % 2 == 0 else "assistant", f"t{i} " + "w " * length) for i in range(n)]
    return turns


def digest(turns):
    loss = "".join(t for role, t in turns if role == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_windows_of_long_conversations(spark):
    convs = {1: conversation(60), 2: conversation(3, 5, False), 3: [("user", "")], 4: conversation(4, 900),
             5: [("assistant", "same")] * 5, 6: [("user", "hi"), ("system", "late"), *conversation(30, 30, False)]}
    rows = [(c, i, r, t, 9) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window int")
    out = chat.windows(df, budget=300, history=60)
    windows = out.collect()
    back = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(out).collect()}
    assert back == {c: digest(t) for c, t in convs.items()}
    by_conv = [sorted((w for w in windows if w.conv_id == c), key=lambda w: w.window) for c in (1, 6)]
    assert len(by_conv[0]) > 10
    assert all(chat.parse_turns(w.formatted)[0] == convs[1][0] for w in by_conv[0])
    assert all(1 < w.n_repeated < w.n_turns for w in by_conv[0][1:])
    assert all(("system", "late") in chat.parse_turns(w.formatted) for w in by_conv[1])
    tokens = chat.turn_tokens(F.col("t"))
    for w in windows:
        turns = chat.parse_turns(w.formatted)
        n = sum(r.n for r in spark.createDataFrame([(t,) for _, t in turns], "t string").select(tokens.alias("n")).collect())
        assert n <= 300 or w.n_turns - w.n_repeated == 1


def test_chat_nulls_ties_and_empty(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (7, 1, "assistant", "b"), (7, 1, "assistant", "b"),
            (7, 1, "assistant", "a"), (7, -5, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    back = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in chat.read_back(chat.windows(df)).collect()}
    assert back == {None: digest([("", ""), ("user", "a")]),
                    7: digest([("user", "first"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")])}
    assert chat.read_back(chat.windows(df.where("false"))).count() == 0


def test_op6_on_all_conversations(spark):
    rows = queries.table(spark, SF_SMALL, "conversations").orderBy("conv_id", "turn").collect()
    convs = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in rows:
        convs.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in queries.op6_chat_format(spark, SF_SMALL).collect()}
    assert got == {c: digest(t) for c, t in convs.items()}


# --- URL filter (8) ---------------------------------------------------------------------

def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://net/", "http://a.NET/x?y#z", "http://net", "http://xnet/",
            "http://a.example.net/en/1", "http://example.net/en", "ftp://example.com/de/?a", "http://b.org/fr/x",
            "http://b.org/FR/x", "http://u@net:80/", "http://x.net?/en/", "http://a://net/", "http://example.com/de/é\n/z",
            "http://" + "a." * 3000 + "net/" + "p" * 9000, "http://net/"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    rules = spark.createDataFrame([*queries.URL_RULES, ("net", "/", "allow"), (None, "/", "block"), ("dup.org", "", "allow")],
                                  "host string, path string, verdict string")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, rules).collect()}
    assert len(got) == len(urls)

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in [*queries.URL_RULES, ("dup.org", "", "allow")]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    for i, url in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == plain(url), url
    none = url_filter.filter_urls(pages, rules.where("false"))
    assert none.where("verdict = 'allow' and rule is null").count() == len(urls)
    assert url_filter.filter_urls(pages.where("false"), rules).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(2000).select(F.concat(F.lit("h\0/"), F.col("id")).alias("key"))
    blocks, words = url_filter.bloom(keys)
    probes = spark.range(4000).select("id", F.concat(F.lit("h\0/"), F.col("id")).alias("key"))
    hit = (probes.join(words, url_filter._block(F.col("key"), blocks) == F.col("block"))
           .where(F.col("word").bitwiseAND(url_filter._mask(F.col("key"))) == url_filter._mask(F.col("key"))))
    assert hit.where("id < 2000").count() == 2000
    assert hit.where("id >= 2000").count() < 100


# --- embeddings (3) ---------------------------------------------------------------------

def test_least_count_is_calibrated():
    rng = np.random.default_rng(0)
    assert embedding_dedup.least_count(96, 1.0, 1e-5) < 96 * 0.68
    counts = (np.abs(rng.standard_normal((20_000, 96))) <= 1).sum(axis=1)
    assert (counts < embedding_dedup.least_count(96, 1.0, 1e-2)).mean() < 0.011


@pytest.mark.parametrize("block", [16, 1024])
def test_embedding_links_match_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(25):  # clusters around the limit, copies among them
        base = rng.standard_normal(24)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), (base + rng.standard_normal(24) * rng.choice([0.0, .2, .3])).tolist(), int(c % 3)))
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 24, 1), (n + 3, [float("nan")] * 24, 1),
             (n + 4, [None] + [1.0] * 23, 1), (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1),
             (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("kept", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           embedding_dedup.near_duplicates(df, block=block).collect()}
    usable = {i: np.array(v) / np.linalg.norm(v) for i, v, l in rows if i is not None and (i < n or i >= n + 6)}
    label = {i: (l, len(v or [])) for i, v, l in rows}
    parent, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in usable:
        for j in usable:
            if i != j and label[i] == label[j] and usable[i] @ usable[j] >= 0.93:
                links[i] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {i: (links[i], root(i), root(i) == i) for i, _, _ in rows if i is not None} | {None: (0, None, None)}
    assert got == want
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)] + [(201, 200), (200, 202)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- mix (9) and prefix sums -----------------------------------------------------------------

def plain_targets(sizes):
    """Share by weight, stop at twice the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in order if s not in full]
        out = {s: 2.0 * sizes[s] if s in full else left * weight[s] / sum(weight[o] for o in open_) for s in order}
        over = [s for s in open_ if out[s] > 2 * sizes[s]]
        if not over:
            return out
        full |= set(over)
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)


def test_mix_meets_its_targets(spark):
    r = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(r.randrange(60))), r.choice(["a", "b", "c", "Z", None])) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "w " * 2000, "c"), (302, "w " * 2000, "c"), (None, "x y", "a"),
             (303, "only one source here", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("mine"))
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    entries, info = mixing.mix(docs)
    took = {x.source: x.n for x in entries.groupBy("source").agg(F.sum("words").alias("n")).collect()}
    for x in info.select("source", "target").distinct().collect():
        assert x.target == pytest.approx(want[x.source])
        assert abs(took.get(x.source, 0) - x.target) <= 1 + len(want)
    assert all(0 <= x.taken <= 2 * x.size for x in got)
    assert sum(x.taken for x in got) <= 1.5 * sum(sizes.values())
    order = entries.orderBy("position").collect()
    assert [x.position for x in order] == list(np.cumsum([0] + [x.words for x in order[:-1]]))
    assert [x.finish for x in order] == sorted(x.finish for x in order)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.taken(docs.repartition(5)).collect()), key=repr)
    assert mixing.taken(docs.where("false")).count() == 0


def test_mixed_documents(spark):
    """Documents come whole, once per turn of which the mix takes at least half."""
    rows = [(i, f"a{i}  b c\td", s, 9) for i, s in enumerate("xxxxyyyyz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    entries, _ = mixing.mix(docs)
    want = Counter(r.doc_id for r in entries.collect() if 2 * r.words >= r.size)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(tuple(r) == rows[r.doc_id] for r in got) and Counter(r.doc_id for r in got) == want
    assert mixing.apply_mix(docs.where("false")).count() == 0


def test_mix_of_many_tiny_sources_keeps_documents_whole(spark):
    r = random.Random(12)
    rows = [(i, " ".join(["w"] * r.randrange(1, 30)), f"s{i // 3:02d}" if i < 180 else None) for i in range(186)]
    rows += [(5, rows[5][1], rows[5][2])] * 2 + [(None, "no id here", "s01"), (900, None, "s01"), (901, "", "s01")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = mixing.apply_mix(docs).collect()
    texts = Counter(rows)
    assert all(tuple(x) in texts for x in got) and max((Counter(map(tuple, got)) - texts - texts).values(), default=0) == 0
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, took = plain_targets(sizes), Counter()
    for x in got:
        took[x.source] += len(x.text.split())
    assert all(abs(took[s] - want[s]) <= 15 for s in sizes)   # half of the longest document


def test_running_totals_cross_chunks(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("k"), (F.col("id") % 7 + 1).alias("v"), "id",
                                 F.expr("id div 9").alias("chunk"))
    got = common.running_totals(df, ["k"], "chunk", ["id"], "v", "before", super_chunk=3).collect()
    seen = {0: 0, 1: 0}
    for r in sorted(got, key=lambda r: r.id):
        assert r.before == seen[r.k]
        seen[r.k] += r.v


# --- oracles and the pipeline -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF_ORACLE)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(map(tuple, cur.fetchall()), key=repr)


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_against_its_stages(spark):
    import corpus_pipeline as P

    docs = queries.table(spark, SF_ORACLE, "documents")
    labels = {r.doc_id: r for r in queries.table(spark, SF_ORACLE, "labels").collect()}
    seen, left = {}, docs
    for name, stage in P.STAGES:
        before = {r.doc_id for r in left.select("doc_id").collect()}
        left = common.cut(stage(spark, left, SF_ORACLE), f"test-{name}")
        seen[name] = {r.doc_id for r in left.select("doc_id").collect()}
        assert seen[name] <= before
        if name != "bpe":
            assert left.columns == docs.columns
    judged = {r.doc_id: r.kept for r in queries.op7_line_quality(spark, SF_ORACLE).collect()}
    assert seen["quality"] == {d for d, k in judged.items() if k}
    assert all(labels[d].quality for d in seen["quality"] if d in labels)
    toxic = [d for d in seen["quality"] if d in labels and labels[d].toxic]
    assert sum(d not in seen["toxicity"] for d in toxic) > 0.8 * len(toxic)
    gone = seen["quality"] - seen["toxicity"]
    assert sum(labels[d].toxic == 0 for d in gone if d in labels) <= 0.02 * len(seen["quality"])
    assert left.where("length(ids) <> 4 * n_tokens").count() == 0
    assert sorted(r.ids_sha256 for r in left.select("ids_sha256").collect()) == sorted(
        r.ids_sha256 for r in P.run(spark, SF_ORACLE).select("ids_sha256").collect())


def test_stages_take_empty_tables_and_nulls(spark):
    import corpus_pipeline as P

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for rows in ([], [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, None, "s", None)]):
        for name, stage in P.STAGES:
            out = stage(spark, spark.createDataFrame(rows, schema), SF_SMALL)
            assert out.count() <= 2 * len(rows)

"""Exact duplicates, conversation repair and the alignment of two tokenizers."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tideline.llm import chat_repair, exact_dedup, queries, token_alignment
from tideline.llm.bpe import byte_alphabet

SPACES = "[\x20\x09-\x0d]+"

# --- exact duplicates (12) ----------------------------------------------------------


def test_golomb_codes_are_read_back():
    r = np.random.default_rng(3)
    for width, n in [(1, 1), (10, 10), (1 << 40, 1), (1 << 40, 1000), (1 << 24, 5000), (7, 3)]:
        values = np.unique(r.integers(0, width, n))
        k = exact_dedup.divisor_bits(width, len(values))
        code = exact_dedup.golomb_encode(values, k)
        assert (exact_dedup.golomb_decode(code, len(values), k) == values).all()
    dense = np.unique(r.integers(0, 1 << 30, 100_000))
    k = exact_dedup.divisor_bits(1 << 30, len(dense))
    assert len(exact_dedup.golomb_encode(dense, k)) * 8 < 16 * len(dense)  # 64 bits a number when they are plain
    assert len(exact_dedup.golomb_decode(b"", 0, 5)) == 0


def plain_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACES, " ", t or "")].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return Counter(out)


def dedup_rows():
    r = random.Random(5)
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a\tb", "a b", " a b", "a b ", "A b", "é\x0b\x0cé", "x" * 300_000,
             "x" * 299_999 + "y", *(f"text {i}" for i in range(40))]
    rows = [(i, r.choice(texts)) for i in range(300)]
    rows += [(1000 + i, "hot\ncopy") for i in range(150)]
    rows += [(7, "a b"), (7, "a b"), (7, "text 1"), (None, "a b"), (None, "only null"), (None, "only null"), (-4, "a b")]
    r.shuffle(rows)
    return rows


DEDUP = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup_equals_plain_grouping(spark):
    rows = dedup_rows()
    df = spark.createDataFrame([(i, t, "c", 0, 1, True) for i, t in rows],
                               "id bigint, body string, text_sha256 string, row int, fp int, kept boolean").repartition(7)
    got = exact_dedup.deduplicate(df, "id", "body")
    assert got.columns == list(DEDUP)
    assert Counter(map(tuple, got.collect())) == plain_dedup(rows)


def test_exact_dedup_with_many_senders_owners_and_hot_groups(spark, monkeypatch):
    rows = dedup_rows()
    monkeypatch.setattr(exact_dedup, "SENDER_BITS", 3)   # 8 rows a sender
    monkeypatch.setattr(exact_dedup, "SMALL_OWNER_ROWS", 10)
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 20)
    monkeypatch.setattr(exact_dedup, "LEAST_BITS", 9)    # chance suspects are many and must not matter
    monkeypatch.setattr(exact_dedup, "SPARE_BITS", 0)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert Counter(map(tuple, exact_dedup.deduplicate(df).collect())) == plain_dedup(rows)


def test_exact_dedup_of_string_ids_and_of_nothing(spark):
    rows = [("b", "x"), ("a", "x"), ("c", None), (None, "x")]
    got = exact_dedup.deduplicate(spark.createDataFrame(rows, "doc_id string, text string"))
    assert Counter(map(tuple, got.collect())) == plain_dedup(rows)
    assert exact_dedup.deduplicate(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_a_split_sender_sends_each_part(spark):
    """A sender whose rows two tasks read: a pair across the parts is found by
    the owner, and both parts' answers end in the sender's one file."""
    df = spark.createDataFrame([(0, 5 << 40), (1, 9 << 40), (2, 5 << 40), (3, 7 << 40)], "row bigint, fp bigint")
    ranges = exact_dedup.Ranges(4)
    sent = exact_dedup.messages(df.repartitionByRange(2, "row"), ranges)
    assert {(r.sender, r.part) for r in sent.collect()} == {(0, 0), (0, 2)}
    marked = []
    for r in exact_dedup.answers(sent, ranges).collect():
        fps = exact_dedup.golomb_decode(r.code, r.n, exact_dedup.divisor_bits(ranges.width, r.n)) + r.owner * ranges.width
        marked += fps[np.unpackbits(np.frombuffer(r.bitmap, np.uint8))[:r.n].astype(bool)].tolist()
    assert marked == [(5 << 40) >> (64 - ranges.bits)] * 2


# --- conversation repair (13) -------------------------------------------------------


def cheapest_plain(rows):
    """Least (cost, audit) of a lattice by plain relaxation, row by row."""
    def grown(states):
        states = dict(states)
        for _ in range(6):
            for q, (c, a) in list(states.items()):
                to = chat_repair.MADE[q][1]
                states[to] = min(states.get(to, (10 ** 9, "")), (c + 5, a + "I"))
        return states

    states = {0: (0, "")}
    for initial, kind, copies in rows:
        after = {}

        def reach(q, cost, audit):
            after[q] = min(after.get(q, (10 ** 9, "")), (cost, audit))

        for q, (c, a) in grown(states).items():
            reach(q, c + 2 * copies, a + "D" * copies)
            if kind != "D":
                more = 5 if kind == "T" else 0
                if initial in chat_repair.STEP[q]:
                    reach(chat_repair.STEP[q][initial], c + more, a + "K")
                reach(chat_repair.MADE[q][1], c + more + 1, a + "R")
        states = after
    return min(grown(states)[q] for q in (0, 3) if q in grown(states))


def random_lattice(r, n):
    return [(r.choice("suauaxt"), r.choice("KKKKTD"), 1) if (k := r.random()) < .8
            else (r.choice("sua"), "D", 1 + int(k * 3)) for _ in range(n)]


def test_bidirectional_search_equals_plain_relaxation():
    r = random.Random(8)
    for k in range(600):
        rows = random_lattice(r, r.randrange(0, 12))
        assert chat_repair.Rows(rows, True).search() == cheapest_plain(rows), rows
    rows = random_lattice(r, 700)
    assert chat_repair.Rows(rows, True).search() == cheapest_plain(rows)


def test_search_over_chunks_equals_search_over_rows():
    r = random.Random(9)
    for _ in range(120):
        rows = random_lattice(r, r.randrange(1, 25))
        size = r.randrange(1, 7)
        tables = []
        for k in range(0, len(rows), size):
            part = chat_repair.Rows(rows[k:k + size], False)
            tables.append([[part.search(q, (to,)) for to in range(4)] for q in range(4)])
        assert chat_repair.Chunks(tables).search() == chat_repair.Rows(rows, True).search()


def repaired_plain(rows):
    """The contract of damage and repair, row by row."""
    out = {}
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c]
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        by_conv[c] += [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for c, turns in by_conv.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        seen, kinds, n = set(), [], Counter()
        for _, role, text in turns:
            end = text.rstrip(" \t\n\x0b\f\r")
            fault = ("blank" if not end else "duplicate" if (role, text) in seen
                     else "truncated" if end[-1] not in ".!?" else "none")
            seen.add((role, text))
            n[fault] += 1
            kinds.append((role[:1], {"blank": "D", "duplicate": "D", "truncated": "T", "none": "K"}[fault], 1))
        illegal = sum(a[1][:1] + b[1][:1] not in {"su", "ua", "au"} for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest_plain(kinds)
        lines, state, left = [], 0, list(turns)
        for letter in audit:
            role, text = ("", "") if letter == "I" else left.pop(0)[1:]
            if letter == "D":
                continue
            role = role if letter == "K" else chat_repair.ROLES[chat_repair.MADE[state][0]]
            lines.append(f"{role}:{text}")
            state = chat_repair.STEP[state][role[0]]
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def chats(seed, n_convs, turns):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "ok. ", "long " * 20 + "end.", "é?\n", "A.", "B.", "C."]
    roles = ["user", "assistant"] * 6 + ["system", "tool", None, ""]
    rows = []
    for c in range(n_convs):
        for t in range(r.randrange(0, turns)):
            row = (c, r.choice([t] * 9 + [t + 3, None, -t]), roles[t % 2] if r.random() < .7 else r.choice(roles), r.choice(texts))
            rows += [row] * (3 if r.random() < .05 else 1)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello.")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk_rows", [4096, 4])
def test_repair_equals_the_plain_version(spark, chunk_rows):
    rows = chats(11, 60, 22)
    df = spark.createDataFrame([(*r, 5, "x") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, place int, audit string")
    got = {r[0]: tuple(r)[1:] for r in chat_repair.repair_damaged(df.repartition(5), chunk_rows).collect()}
    assert got == repaired_plain(rows)


def test_repair_of_one_conversation_with_most_rows(spark):
    """One conversation of thousands of rows, many of them equal, in small chunks."""
    r = random.Random(2)
    rows = [(1, t, ["user", "assistant"][t % 2], r.choice([f"Turn {t}.", "ok.", "cut"])) for t in range(1500)]
    rows += [(1, 1500, "user", "Same.")] * 700 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in chat_repair.repair_damaged(df, 64).collect()}
    assert got == repaired_plain(rows)


def test_repair_of_dropped_and_absent_conversations(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in chat_repair.repair_damaged(df).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert chat_repair.repair_damaged(df.limit(0)).collect() == []


# --- alignment of two tokenizers (11) -----------------------------------------------


def aligned_plain(rows):
    """The contract by the two libraries, whole texts and all pairs of a group."""
    tokenizer = Tokenizer.from_file(queries.BPE_FILE)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_FILE)
    alphabet, name = byte_alphabet(), {v: k for k, v in tokenizer.get_vocab().items()}

    def bytes_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends[:-1]], ends))

    docs, counts = [], Counter()
    for d, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw_a, raw_b = [bytes(alphabet[c] for c in name[i]) for i in a], [bytes_b(i) for i in b]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            docs.append((d, [], [], [], []))
            continue
        at_a, at_b = spans(raw_a), spans(raw_b)
        groups, links, i, j = [], [], 0, 0
        for c in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            p, q = i, j
            i = sum(e <= c for _, e in at_a) if len(at_a) < 400 else next(k for k in range(i, len(at_a) + 1) if k == len(at_a) or at_a[k][1] > c)
            j = sum(e <= c for _, e in at_b) if len(at_b) < 400 else next(k for k in range(j, len(at_b) + 1) if k == len(at_b) or at_b[k][1] > c)
            groups.append((a[p:i], b[q:j]))
            links += [(a[u], b[v]) for u in range(p, i) for v in range(q, j)
                      if at_a[u][0] < at_b[v][1] and at_b[v][0] < at_a[u][1]]
        docs.append((d, a, b, groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return Counter(
        (d, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()
         if a else "") for d, a, b, groups, links in docs)


HARD = [None, "", " ", "  ", "\n", "a ", " a", "a  b", "a   b  ", "\n\na", "a\n b", "a \nb", "tab\there", "a\r\nb\n",
        "<|endoftext|>", "x <s> </s> <unk> <0x41>", "▁x", "a▁b", "naïve café", "日本語テスト", "🎉🎉 party", " nb", "it's we'll",
        "((())) == !!", "12345 678", "ooooooooooooo", "aaaaaaaaaaaaaaaaaaaaaaaaa", "zz\x00z", "mixed　wide", "\x1c \x1f",
        "word " * 3000, "e" * 5000, "\t", "a\n\n\nb  c\td", "Ünïcödé ﬁ ﬂ ½", "áé"]


@pytest.mark.parametrize("head_bits", [20, 3])
def test_alignment_equals_the_libraries(spark, monkeypatch, head_bits):
    monkeypatch.setattr(token_alignment, "HEAD_BITS", head_bits)   # 3: nearly all pairs are joined
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").limit(60).collect()]
    rows = list(enumerate([*HARD, *texts, *HARD[:20]])) + [(3, "same id"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "id bigint, body string, row int, same binary").repartition(3)
    got = token_alignment.align(df, queries.BPE_FILE, queries.PIECE_FILE, "id", "body")
    assert Counter(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                         "groups_sha256").collect())) == aligned_plain(rows)


def test_alignment_of_nothing_and_of_a_long_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_alignment.align(empty, queries.BPE_FILE, queries.PIECE_FILE).collect() == []
    long = spark.createDataFrame([(1, "many words of one text\n" * 60_000)], "doc_id bigint, text string")
    row = token_alignment.align(long, queries.BPE_FILE, queries.PIECE_FILE).collect()[0]
    assert row.n_a == row.n_b == row.n_links == 360_000 and row.n_best == row.n_links


def test_words_forgotten_between_chunks_are_aligned_again():
    import pyarrow as pa

    tool = token_alignment.aligner(queries.BPE_FILE, queries.PIECE_FILE)

    def run(keep):
        chunks = [(pa.RecordBatch.from_arrays([pa.array([k]), pa.array([k])], ["row", "doc_id"]), [f"some words {k} of text"])
                  for k in range(6)]
        return [b.to_pylist() for b in tool.documents(iter(chunks), keep)]

    assert run(2) == run(10_000)


# --- the query without SQL --------------------------------------------------------------------


def test_alignment_query_covers_every_document(spark):
    df = queries.op11_token_alignment(spark, SF_SMALL)
    docs = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert Counter(map(tuple, df.collect())) == aligned_plain(docs)

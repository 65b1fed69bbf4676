"""One query per operator, over its whole table, and their DuckDB oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, chat, chat_repair, embedding_dedup, exact_dedup, licenses, line_quality, mixing, near_dup,
               token_alignment, toxicity, training_order, url_filter)

#: The public tokenizers' vocabulary files.
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as shards in training order and read back: every
    slot with its sequence's number and digest."""
    docs = table(spark, sf_dir, "documents").select("text", "_metadata.file_path", "_metadata.file_block_start")
    folder = scratch_path(spark, f"order-shards-{uuid.uuid4().hex}")
    manifest = training_order.write_shards(docs, BPE_FILE, folder, place=("file_path", "file_block_start"))
    n = manifest.agg(F.sum("n_sequences").alias("n")).collect()[0]["n"] or 0
    if not n:
        return spark.createDataFrame([], "slot bigint, sequence bigint, shard bigint, ids_sha256 string")
    slots = training_order.read_shards(spark, folder).select("slot", "shard", F.sha2("ids", 256).alias("ids_sha256"))
    return training_order.with_sequence(slots, n).select("slot", "sequence", "shard", "ids_sha256")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence found in a document, with its place."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _op4_sql() -> str:
    known: dict[str, int] = {}
    rules = [(name, [known.setdefault(s, len(known)) for s in parts]) for name, parts in licenses.RULES]
    quoted = {s.replace("'", "''"): i for s, i in known.items()}
    return f"""
WITH known(sid, raw) AS (VALUES {", ".join(f"({i}, '{s}')" for s, i in quoted.items())}),
sids AS (SELECT sid, trim(regexp_replace(lower(raw), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS sentence FROM known),
rules(licence, ids) AS (VALUES {", ".join(f"('{name}', {ids})" for name, ids in rules)}),
cut AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\r\\n\\f]+', '\\1' || chr(10), 'g'), chr(10)) AS parts
  FROM documents WHERE text IS NOT NULL),
each_one AS (SELECT doc_id, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM cut),
hits AS (
  SELECT doc_id, list(pos ORDER BY pos) AS places, list(sid ORDER BY pos) AS ids
  FROM each_one JOIN sids ON trim(regexp_replace(lower(raw), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) = sentence
  GROUP BY doc_id),
starts AS (SELECT *, unnest(range(1, len(ids) + 1)) AS k FROM hits),
found AS (
  SELECT doc_id, licence, places[k] AS first, places[k + len(rules.ids) - 1] AS last
  FROM starts JOIN rules ON list_slice(starts.ids, k, k + len(rules.ids) - 1) = rules.ids
  WHERE places[k + len(rules.ids) - 1] - places[k] <= len(rules.ids) - 1 + {licenses.GAP}),
marked AS (
  SELECT *, max(last) OVER (PARTITION BY doc_id ORDER BY first, last DESC, licence
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM found)
SELECT doc_id, licence, first::INTEGER AS first, last::INTEGER AS last FROM marked
WHERE reached IS NULL OR reached < last
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, learnt from the rows not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own marks,
    formatted into windows and read back."""
    hard = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return chat.read_back(chat.windows(turns.unionByName(extra)))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of its labelled lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge(docs, field).drop("text")


#: The list of the URL query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)?', 1) AS path FROM a),
r(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
f AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM u JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN f USING (page_id)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
f AS (SELECT *, source_size * 2 AS cap, (source_size * 2)::DOUBLE / weight AS fills FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY fills, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY fills, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, weight * (SELECT max(level) FROM l WHERE level <= fills)) AS target FROM l),
k AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, md5('mix:' || d.doc_id) AS key,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, greatest(0, least(size, floor(target + 0.5)::BIGINT - (start + turn * source_size))) AS served
  FROM k CROSS JOIN (VALUES (0), (1)) AS turns(turn)),
p AS (
  SELECT doc_id, served,
         coalesce(sum(served) OVER (ORDER BY (start + turn * source_size + served) / target,
                                             coalesce('s' || source, 'null'), turn, key, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
  FROM e WHERE served > 0),
g AS (
  SELECT doc_id, sum(greatest(0, least(served, (SELECT floor(sum(source_size) * 1.5) FROM s) - position))) AS taken
  FROM p GROUP BY doc_id)
SELECT k.doc_id, k.size, k.source_size, k.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM k LEFT JOIN g USING (doc_id)
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, BPE_FILE)
    return bpe.decode(ids.select("doc_id", "ids"), BPE_FILE).select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens in two vocabularies, aligned."""
    return token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), BPE_FILE, PIECE_FILE)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP12_SQL = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged and repaired."""
    return chat_repair.repair_damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def _op13_sql() -> str:
    """The same cheapest edits by a walk over the rows: a state's best is its
    cost in ten digits and its audit, so the least string is the least of both."""
    def edit(state: str, cost: str, letter: str) -> str:
        return f"(printf('%010d', substr({state}, 1, 10)::BIGINT + {cost}) || substr({state}, 11) || '{letter}')"

    def least(state: str, *options: str) -> str:
        return f"least({', '.join([state, *options])})"

    def stays(option: str, initial: str = "") -> str:
        return "CASE WHEN fault NOT IN ('blank', 'duplicate')" + (f" AND initial = '{initial}'" if initial else "") + f" THEN {option} END"

    late = "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"
    to_user = [x for q in ("q0", "q1", "c3") for x in (stays(edit(q, late, "K"), "u"), stays(edit(q, f"1 + {late}", "R")))]
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                                                                        ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda x: ord(x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, range(2) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ends,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos
  FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, pos, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         CASE WHEN ends = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN right(ends, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed),
counts AS (
  SELECT c.conv_id, count(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
  GROUP BY c.conv_id),
walk AS (
  SELECT conv_id, n, 0::BIGINT AS pos, '0000000000' AS q0, NULL::VARCHAR AS q1, NULL::VARCHAR AS q2, NULL::VARCHAR AS q3
  FROM counts
  UNION ALL
  SELECT conv_id, n, pos + 1, {edit("q0", "2", "D")},
         {least(edit("q1", "2", "D"), stays(edit("q0", late, "K"), "s"))},
         {least(edit("c2", "2", "D"), *to_user)},
         {least(edit("c3", "2", "D"), stays(edit("c2", late, "K"), "a"), stays(edit("c2", f"1 + {late}", "R")))}
  FROM (SELECT *, {least("q3", edit("c2", "5", "I"))} AS c3
        FROM (SELECT w.*, f.fault, f.initial, {least("q2", *[edit(q, "5", "I") for q in ("q0", "q1", "q3")])} AS c2
              FROM walk AS w JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1))),
solved AS (
  SELECT conv_id, least(q0, q3, {edit("c2", "5", "I")}) AS best
  FROM (SELECT *, {least("q2", *[edit(q, "5", "I") for q in ("q0", "q1", "q3")])} AS c2 FROM walk WHERE pos = n)),
edits AS (SELECT conv_id, substr(best, 1, 10)::BIGINT AS cost, substr(best, 11) AS audit FROM solved),
replay AS (
  SELECT conv_id, audit, 0::BIGINT AS k, 0::BIGINT AS pos, '' AS state, []::VARCHAR[] AS lines FROM edits
  UNION ALL
  SELECT r.conv_id, audit, k + 1, r.pos + CASE WHEN letter = 'I' THEN 0 ELSE 1 END,
         CASE WHEN letter = 'D' THEN state ELSE left(new_role, 1) END,
         CASE WHEN letter = 'D' THEN lines ELSE list_append(lines, new_role || ':' || new_text) END
  FROM (SELECT r.*, letter, CASE WHEN letter = 'K' THEN f.role WHEN state = 'u' THEN 'assistant' ELSE 'user' END AS new_role,
               CASE WHEN letter = 'I' THEN '' ELSE f.text END AS new_text
        FROM (SELECT *, audit[k + 1] AS letter FROM replay WHERE k < length(audit)) AS r
        LEFT JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.pos + 1) AS r)
SELECT c.conv_id, c.gaps::BIGINT AS gaps, c.blank, c.duplicate, c.truncated, c.illegal, e.cost, e.audit,
       sha256(array_to_string(r.lines, chr(10))) AS repaired_sha256
FROM counts AS c JOIN edits AS e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
JOIN replay AS r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.k = length(r.audit)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dup": op1_near_dup,
    "op2_training_order": op2_training_order,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_chat_format": op6_chat_format,
    "op7_line_quality": op7_line_quality,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_token_alignment": op11_token_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_chat_repair": op13_chat_repair,
}

ORACLES: dict[str, str] = {
    "op4_license_scan": _op4_sql(),
    "op8_url_filter": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_chat_repair": _op13_sql(),
}

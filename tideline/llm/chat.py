"""Chat formatting into budgeted windows of whole turns.

Prefix sums of the turns' tokens give every turn its place in the
conversation. The conversation is cut at multiples of a stride; the turns that
start between two cuts are one window's new turns, so where a window begins
needs nothing but the sums. In front of them a window repeats the system turn
and the last turns before it, as far as the history budget goes. Only an
assistant turn's first appearance is under the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, running_totals

#: Tokens that a window holds, of which repeated turns take so many at most.
#: A window of new turns alone is over it only if it holds one longer turn.
BUDGET = 1024
HISTORY = 192
#: Tokens that the marks around a turn count for.
TURN_TOKENS = 4
#: Turn numbers that share a running-total chunk.
TURNS_PER_CHUNK = 4096

SYSTEM, TARGET = "system", "assistant"

# The template: "### <role>: <text></turn>\n" for every turn. Inside roles and
# texts a backslash goes before each backslash and control string, so neither
# "### " nor "</turn>" stands there bare.
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
# Possessive repeats: the parts can't match in two ways, and the matcher keeps no place to return to per character.
_TURN = re.compile(r"### ((?:[^\\:]++|\\(?:\\|###|</turn>|:))*+): ((?:[^\\<]++|<(?!/turn>)|\\(?:\\|###|</turn>))*+)</turn>\n",
                   re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def format_turns(turns: list[tuple[str, str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns ``(role, text, repeated)`` and the spans (in code
    points) under the loss mask: the texts of targets that aren't repeated."""
    out, spans, at = [], [], 0
    for role, text, repeated in turns:
        head = f"### {_ROLE_CONTROL.sub(lambda m: chr(92) + m[0], role)}: "
        body = escape(text)
        if role == TARGET and not repeated:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at} of a formatted window")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn: words and single marks, and the template's own."""
    return (F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + TURN_TOKENS).cast("bigint")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of ``conv_id, turn, role, text`` rows: ``conv_id, window`` (rank
    value that grows along the conversation), ``n_repeated`` (turns at its
    head that an earlier window already has), ``n_turns``, ``formatted`` and
    ``loss_spans`` (begin and end in code points).

    Turns stand in the order of ``turn``, null first; ties go by role, then
    text; repeated rows are turns of their own. Null roles and texts count as
    empty. Rows with a null ``conv_id`` form one conversation, which is none
    that a string id could name. A turn of any length is formatted and read
    back whole, with a small multiple of its memory. The system turn
    is a conversation's first turn with that role: it keeps its place and is
    repeated in every later window; it counts against the budget only as far
    as half of it. Extra columns are not looked at; an empty table gives no
    windows. Turns of one conversation lie in chunks of
    :data:`TURNS_PER_CHUNK` turn numbers, which bound what meets in one task.
    """
    rows = turns.select(
        "conv_id", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null")).alias("__conv"),
        F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n", turn_tokens(F.col("text")))
    rows = rows.withColumn("__chunk", F.expr(f"greatest(coalesce(turn, 0), 0) div {TURNS_PER_CHUNK}"))
    rows = cut(rows, "chat-turns")
    placed = running_totals(rows, ["__conv"], "__chunk", ["turn", "role", "text"], "n", "start").drop("__chunk")
    placed = cut(placed, "chat-placed")

    first = (placed.where(F.col("role") == SYSTEM).groupBy("__conv")
             .agg(F.min(F.struct("start", "n", "text")).alias("sys")))
    placed = placed.join(first.select("__conv", F.col("sys.n").alias("__sys")), "__conv", "left")
    room = F.lit(budget - history) - F.least(F.coalesce("__sys", F.lit(0)), F.lit(budget // 2))
    stride = F.greatest(F.lit(history), F.expr("__room div 2"))
    placed = placed.withColumn("__room", room.cast("bigint")).withColumn("__stride", stride)
    # a turn longer than the stride is the last that starts in its cell and gets a window alone
    window = F.expr("2 * (start div __stride)") + F.when(F.col("n") > F.col("__stride"), 1).otherwise(0)
    placed = placed.withColumn("window", window).drop("__sys", "__room")

    begins = placed.groupBy("__conv", "window").agg(F.min("start").alias("begin"))
    # a turn can be history of the next windows only: the stride is no shorter than the history budget
    near = (placed.withColumn("window", F.explode(F.filter(
                F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.col("window") + k),
                lambda w: w <= F.expr("2 * (start div __stride) + 3"))))
            .join(begins, ["__conv", "window"])
            .where((F.col("begin") > F.col("start")) & (F.col("begin") - F.col("start") <= history)))
    kept = ["__conv", "conv_id", "window", "start", "role", "text"]
    sys_rows = (begins.join(first, "__conv").where(F.col("sys.start") < F.col("begin"))
                .join(placed.groupBy("__conv").agg(F.first("conv_id").alias("conv_id")), "__conv")
                .where(F.col("begin") - F.col("sys.start") > history)
                .select("__conv", "conv_id", "window", F.col("sys.start").alias("start"),
                        F.lit(SYSTEM).alias("role"), F.col("sys.text").alias("text")))
    repeated = near.select(*kept).unionByName(sys_rows).withColumn("repeated", F.lit(True))
    members = placed.select(*kept).withColumn("repeated", F.lit(False)).unionByName(repeated)
    # turns of a window are bounded by the budget: each counts at least TURN_TOKENS
    grouped = members.groupBy("__conv", "window").agg(
        F.first("conv_id").alias("conv_id"),
        F.sort_array(F.collect_list(F.struct("start", "role", "text", "repeated"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, n_turns, n_repeated = [], [], [], []
            for turns_ in batch.column("turns").to_pylist():
                # repeated turns come before new ones anyway: they start earlier
                text, loss = format_turns([(t["role"], t["text"], t["repeated"]) for t in turns_])
                texts.append(text)
                spans.append([{"begin": b, "end": e} for b, e in loss])
                n_turns.append(len(turns_))
                n_repeated.append(sum(t["repeated"] for t in turns_))
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("window"), pa.array(n_repeated, pa.int32()),
                 pa.array(n_turns, pa.int32()), pa.array(texts, pa.string()), pa.array(spans, kind)],
                ["conv_id", "window", "n_repeated", "n_turns", "formatted", "loss_spans"])

    kind = grouped.schema["conv_id"].dataType.simpleString()
    return grouped.select("conv_id", "window", "turns").mapInArrow(
        run, f"conv_id {kind}, window bigint, n_repeated int, n_turns int, formatted string, "
             "loss_spans array<struct<begin:bigint,end:bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from the windows alone: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Windows are sorted by conversation and place inside their partitions and
    go through the hashes one by one, so a conversation of any length takes
    the memory of one window. (A SHA-256 runs in order: one conversation's
    digest is one task's work, whatever the method.)
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Digest:
            def __init__(self, conv):
                self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
                self.n = self.loss_chars = self.chars = 0

            def row(self):
                return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)

        now: Digest | None = None
        id_type = None

        def packed(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(cols, types)], names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            done = []
            for conv, repeated, text, spans in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "n_repeated", "formatted", "loss_spans"))):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Digest(conv)
                for role, turn in parse_turns(text)[repeated:]:
                    now.turns.update(f"{role}\n{turn}\n".encode())
                    now.n += 1
                for span in spans:
                    part = unescape(text[span["begin"]:span["end"]])
                    now.loss.update(part.encode())
                    now.loss_chars += len(part)
                now.chars += len(text)
            if done:
                yield packed(done)
        if now is not None:
            yield packed([now.row()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.select("conv_id", "n_repeated", "formatted", "loss_spans", "window").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")

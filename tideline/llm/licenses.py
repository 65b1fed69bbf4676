"""Licence scan by sentence rules.

A text is cut into sentences, once with every line end as an end and once with
the lines of a paragraph joined, each normalised to its words in lower case. A
hash table held by every task maps sentences to the identifiers of known
licence sentences, and the licences' rules, which are ordered sequences of
identifiers, are looked for in the documents' identifier sequences.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal

# Sentences of public licence texts and notices. A rule is a
# licence and the sentences that show it, in order.
RULES = [
    ("GPL-3.0", ["This work is licensed under the GNU General Public License, version 3."]),
    ("CC-BY-NC-4.0", ["Licensed under CC BY-NC 4.0."]),
    ("MIT", ["Released under the MIT License."]),
    ("Apache-2.0", ["Licensed under the Apache License, Version 2.0."]),
    ("All-rights-reserved", ["All rights reserved."]),
    ("Apache-2.0-notice", [
        "Licensed under the Apache License, Version 2.0 (the \"License\");"
        " you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at"]),
    ("MIT-text", [
        "The above copyright notice and this permission notice shall be included in all copies"
        " or substantial portions of the Software."]),
    ("BSD-text", [
        "Redistributions of source code must retain the above copyright notice, this list of conditions"
        " and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions"
        " and the following disclaimer in the documentation and/or other materials provided with the distribution."]),
    ("MIT-with-rights", ["Released under the MIT License.", "All rights reserved."]),
]
#: Other sentences that may stand between two sentences of a rule.
GAP = 3
#: Known sentences at most: their table is held by every task.
MAX_SENTENCES = 50_000


_END = re.compile(r"([.!?])[ \t\r\n\f]+|\n")
_NO_WORD = re.compile(r"[\W_]+")


def normalise(sentence: str) -> str:
    return _NO_WORD.sub(" ", sentence.lower()).strip()


def hits(text: str, known: dict[str, int]) -> list[tuple[int, int, int, bool, int]]:
    """``begin, end, number, whole, sid`` of a text's known sentences, in
    order. Pieces are cut at line ends and after ``.``, ``!`` or ``?`` before
    white space; ``begin`` and ``end`` are numbers of pieces. A sentence
    is one piece (``whole``) or several that only single line ends divide,
    comment marks not counted; ``number`` counts these joined sentences."""
    out, run, begin, number, at, place = [], [], 0, 0, 0, 0

    def close():
        nonlocal number
        if len(run) > 1:
            sid = known.get(" ".join(run))
            if sid is not None:
                out.append((begin, place - 1, number, False, sid))
        number += bool(run)
        run.clear()

    while True:
        m = _END.search(text, at)
        piece = normalise(text[at:m.start() if m else len(text)])
        if not piece:
            close()
        else:
            if not run:
                begin = place
            run.append(piece)
            sid = known.get(piece)
            if sid is not None:
                out.append((place, place, number, True, sid))
        place += 1
        if m is None:
            close()
            return sorted(out)
        if m.group(1):
            close()
        at = m.end()


def matches(found: list[tuple[int, int, int, bool, int]], rules: list[tuple[str, list[int]]], gap: int
            ) -> set[tuple[str, int, int]]:
    """``licence, first, last`` of the rules whose identifiers stand in
    ``found`` in order, with at most ``gap`` other sentences between them:
    pieces between two whole ones, joined sentences beside a joined one."""
    starts: dict[int, list[tuple[str, list[int]]]] = {}
    for name, ids in rules:
        starts.setdefault(ids[0], []).append((name, ids))
    out = set()
    for k, hit in enumerate(found):
        for name, ids in starts.get(hit[4], ()):
            states = {(k, 0)}  # last hit, sentences between so far
            for sid in ids[1:]:
                after = set()
                for at, used in states:
                    _, end, number, whole, _ = found[at]
                    for nxt in range(at + 1, len(found)):
                        b, _, n, w, s = found[nxt]
                        between = b - end - 1 if whole and w else max(n - number - 1, 0)
                        if used + between > gap:
                            if n - number - 1 > gap:
                                break
                        elif b > end and s == sid:
                            after.add((nxt, used + between))
                states = after
            out |= {(name, hit[0], found[at][1]) for at, _ in states}
    return out


def _scanner(rules, gap: int):
    known: dict[str, int] = {}
    numbered = [(name, [known.setdefault(normalise(s), len(known)) for s in parts]) for name, parts in rules]
    if len(known) > MAX_SENTENCES:
        raise ValueError(f"{len(known)} known sentences; the scan holds {MAX_SENTENCES} at most")
    known.pop("", None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, of = [], []
            for k, cell in enumerate(batch.column("text")):
                text = cell.as_py()
                found = matches(hits(text, known), numbered, gap)
                if found:
                    digest = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()
                    rows += [(digest, *m) for m in sorted(found)]
                    of += [k] * len(found)
            digests, names, first, last = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(digests, pa.string()),
                 pa.array(names, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                ["doc_id", "digest", "licence", "first", "last"])

    return run


def scan(docs: DataFrame, rules=RULES, gap: int = GAP, text: str = "text") -> DataFrame:
    """``doc_id, licence, first, last``: one row per licence found in a
    document, with the numbers of its first and last sentence.

    A rule matches where its identifiers stand in order in the document's
    sequence of known sentences, with at most ``gap`` other sentences in all
    between them. A sentence may be wrapped over lines, behind comment marks
    too. A match inside a longer one is left out; of two with the same place
    the first by name stays.
    Null and empty texts match nothing. Repeated rows (same id and text) are
    scanned once, rows with a null id like any others; extra columns are not
    looked at; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col(text).alias("text")).where("text is not null")
    kind = rows.schema["doc_id"].dataType.simpleString()
    matched = rows.mapInArrow(frugal(_scanner(rules, gap)),
                              f"doc_id {kind}, digest string, licence string, first int, last int").distinct()
    earlier = (Window.partitionBy("doc_id", "digest").orderBy("first", F.desc("last"), "licence")
               .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.coalesce(F.max("last").over(earlier) >= F.col("last"), F.lit(False))
    return matched.withColumn("covered", covered).where("not covered").select("doc_id", "licence", "first", "last")

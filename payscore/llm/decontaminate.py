"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in small letters, with every run of other signs as one blank. A test item of ``m``
characters may differ by ``k = m * error_percent / 100`` edits. Cut into k + 1 pieces, an occurrence
with k edits has at least one piece unchanged; so every exact piece hit is found (one automaton for
all pieces), and around each the edit distance of the item to the best substring is computed with
Myers' bit-parallel recurrence. Hits whose surroundings overlap are verified together.

The test items go to the workers in blocks of bounded size, each block against all documents.

Items with fewer than ``exact_under`` characters are searched for without edits, as whole words.

Nulls: a null text matches nothing, and a null item, or one without a letter or digit, is not searched
for. Repeated items give a row each. Of an item's places in a document the one with the least distance
is given, of equal ones the first. An empty table on either side gives no match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import table

_WORDS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Matching:
    """Edits allowed, the items searched for without edits, and the characters of one block of items."""

    error_percent: int = 8
    exact_under: int = 24
    block_chars: int = 2_000_000


def normalised(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def pieces_of(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_end(item: str, text: str) -> tuple[int, int]:
    """Edit distance of ``item`` to the best substring of ``text``, and where the first such one ends."""
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xh = ((((eq & pv) + pv) ^ pv) | eq) & mask
        ph = mv | (mask & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        xv = eq | mv
        pv = ((mh << 1) & mask) | (mask & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Items:
    """A block of test items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], rule: Matching):
        self.exact = rule.exact_under
        self.texts = [
            (key, text, 0 if len(text) < self.exact else len(text) * rule.error_percent // 100) for key, text in items
        ]
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, errors) in enumerate(self.texts):
            for at, piece in pieces_of(text, errors):
                found.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best place of each item found in a normalised text."""
        spans: dict[int, list[tuple[int, int]]] = {}
        whole: dict[int, tuple[int, int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, at in where:
                _, item, errors = self.texts[n]
                start = last + 1 - size - at
                if len(item) >= self.exact:
                    spans.setdefault(n, []).append((max(0, start - errors), start + len(item) + errors))
                elif n not in whole and text[start - 1 : start] in ("", " ") and text[last + 1 : last + 2] in ("", " "):
                    whole[n] = (start, last + 1)
        out = [(self.texts[n][0], 0, *place) for n, place in whole.items()]
        for n, near in spans.items():
            key, item, errors = self.texts[n]
            best = None
            for a, b in _merged(near):
                distance, end = best_end(item, text[a:b])
                if distance <= errors and (best is None or distance < best[0]):
                    back, size = best_end(item[::-1], text[a : a + end][::-1])
                    best = (distance, a + end - size, a + end)
            if best:
                out.append((key, *best))
        return out


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    spans = sorted(set(spans))
    a, b = spans[0]
    for c, d in spans[1:]:
        if c <= b:
            b = max(b, d)
        else:
            yield a, b
            a, b = c, d
    yield a, b


def in_original(text: str, start: int, end: int) -> tuple[int, int]:
    """The place in a text of a place in its normalised form."""
    low, at, first, last = text.lower(), 0, None, 0
    if len(low) != len(text):  # a letter whose small form is longer
        low = "".join(c.lower()[:1] or c for c in text)
    for m in _WORDS.finditer(low):
        size = m.end() - m.start()
        if at + size > start and first is None:
            first = m.start() + max(0, start - at)
        if at < end:
            last = m.start() + min(size, end - at)
        at += size + 1
        if at >= end:
            break
    return first or 0, last


def _blocks(benchmark: DataFrame, rule: Matching) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of bounded size."""
    chars = benchmark.agg(F.sum(F.char_length("text"))).first()[0] or 0
    many = max(1, -(-chars // rule.block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(many))
    for n in range(many):
        rows = benchmark.where(block == n).select("item_id", "text").collect()
        items = [(r["item_id"], normalised(r["text"])) for r in rows if r["text"]]
        items = [(k, t) for k, t in items if t]
        if items:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame, rule: Matching = Matching()) -> DataFrame:
    """doc_id, item_id, distance, start, end: the best place of each test item in each document."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance long, start long, end long"
    found = []
    for block in _blocks(benchmark, rule):
        given = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            items = Items(given.value, rule)
            for batch in batches:
                at, rows = [], []
                for i, x in enumerate(batch.column(1)):
                    text = x.as_py()
                    for key, distance, start, end in items.matches(normalised(text)) if text else ():
                        at.append(i)
                        rows.append((key, distance, *in_original(text, start, end)))
                ids = batch.column(0).take(pa.array(at, pa.int64()))
                columns = [pa.array([r[c] for r in rows], pa.from_numpy_dtype("int64")) for c in range(4)]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "item_id", "distance", "start", "end"])

        found.append(docs.select("doc_id", "text").mapInArrow(run, schema))
    if not found:
        none = [F.lit(None).cast(x.split(" ")[1]).alias(x.split(" ")[0]) for x in schema.split(", ")]
        return spark.range(0).select(*none)
    return reduce(DataFrame.unionByName, found)


def without_leaks(docs: DataFrame, benchmark: DataFrame, rule: Matching = Matching()) -> DataFrame:
    """The documents in which no test item is found, with their own columns."""
    column = docs.columns.index("text")
    for block in _blocks(benchmark, rule):
        given = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            items = Items(given.value, rule)
            for batch in batches:
                texts = (x.as_py() for x in batch.column(column))
                yield batch.filter(pa.array([not t or not items.matches(normalised(t)) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

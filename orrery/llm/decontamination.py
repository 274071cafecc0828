"""Benchmark decontamination: test items found in documents within an edit distance, by pigeonhole pieces and Myers' algorithm.

An item with a budget of k errors is cut into k + 1 pieces. Wherever the item is in a text with at most k errors, one piece is
there without error. An Aho-Corasick automaton finds all pieces of all items in one pass over a text; around each hit Myers'
bit-parallel algorithm computes the least edit distance of the whole item to any part of the text. Nothing else is compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, table

#: Errors allowed for each character of an item; bytes of items that are matched in one pass over the documents.
RATE, BLOCK_BYTES = 0.08, 16 << 20
#: Distances that a worker remembers, of items and windows of at most so many characters together.
REMEMBERED, SHORT = 4_096, 2_048

_gaps = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    """Letters and digits in lower case; what lies between them becomes one space."""
    return _gaps.sub(" ", text.lower()).strip()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into errors + 1 pieces of near equal length, each with its place."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(item: str, text: str) -> int:
    """The least edit distance between `item` and any substring of `text` (Myers 1999), with one big integer as the column."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        equal = masks.get(c, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
    return best


_remembered = lru_cache(REMEMBERED)(myers)


def _distance(item: str, text: str) -> int:
    """Copies of a passage are compared once, as long as they are short enough to be remembered."""
    return (_remembered if len(item) + len(text) <= SHORT else myers)(item, text)


@dataclass
class Matcher:
    """Items (item_id, normalised text) and the automaton of their pieces."""

    items: list[tuple[int, str]]
    rate: float

    def __post_init__(self) -> None:
        import ahocorasick

        self.errors = [int(self.rate * len(text)) for _, text in self.items]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, self.errors[i]):
                where.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if len(self.automaton):
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, errors allowed) of all items that are in the text within their budget."""
        if not len(self.automaton):
            return []
        text = normalised(text)
        starts: dict[int, set[int]] = {}
        for last, (size, at) in self.automaton.iter(text):
            for i, offset in at:
                starts.setdefault(i, set()).add(last + 1 - size - offset)
        out = []
        for i, found in starts.items():
            (item_id, item), k = self.items[i], self.errors[i]
            windows: list[list[int]] = []
            for s in sorted(found):
                if windows and s - windows[-1][1] <= k:
                    windows[-1][1] = s
                else:
                    windows.append([s, s])
            distance = min(_distance(item, text[max(0, a - k) : b + len(item) + k]) for a, b in windows)
            if distance <= k:
                out.append((item_id, distance, k))
        return sorted(out)


_matchers: dict[tuple, Matcher] = {}


def matcher(items: list[tuple[int, str]], rate: float) -> Matcher:
    """One for each worker process and block of items."""
    key = (rate, len(items), hash(tuple(items)))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, rate)
    return _matchers[key]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in blocks of about `block_bytes` bytes, so that what a pass over the documents carries is bounded.

    Items without letters or digits, null ones among them, match nothing and are left out; equal rows count once.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        found = sorted({(r.item_id, t) for r in rows if (t := normalised(r.text))}, key=lambda x: (x[0] is None, x))
        if found:
            yield found


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("errors", pa.int32())])


def contaminations(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, errors of every item in every document that has it within floor(rate * characters) errors.

    Case, punctuation and white space don't count. Null and empty texts hold nothing. Repeated rows are each reported, with
    their own doc_id, which may be null. Other columns are ignored; without items or documents there are no rows.
    """
    schema = "doc_id long, item_id long, distance int, errors int"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in blocks(benchmark):

        def work(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            m = matcher(items, rate)
            for b in batches:
                rows = [(d, *x) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) if t.is_valid for x in m.find(t.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FOUND, strict=True)], schema=FOUND)

        out = out.unionByName(in_arrow(docs, work, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of `docs`, with all their columns untouched, whose text holds no item. Without a join, in the rows' own partitions.

    Null and empty texts stay; of repeated rows all stay or none.
    """
    for items in blocks(benchmark):

        def work(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            m = matcher(items, rate)
            for b in batches:
                yield b.filter(pa.array([not (t.is_valid and m.find(t.as_py())) for t in b.column("text")], pa.bool_()))

        docs = in_arrow(docs, work, docs.schema)
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

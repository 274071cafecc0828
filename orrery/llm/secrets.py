"""Secrets in texts: patterns of known forms, and windows of high entropy in long strings, but for what an allow-list covers."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, table

# The base patterns and the least lengths of what they find.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
#: Runs below the least length are dropped anyway, and a run's later parts are shorter, so the length is in the pattern.
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")

#: Characters of a window, and the classes of characters: name, what a candidate is made of, least bits a character.
WIDTH = 20
CLASSES = (("entropy_hex", "0-9A-Fa-f", 3.0), ("entropy_alnum", "0-9A-Za-z", 3.7), ("entropy_base64", "0-9A-Za-z+/_=-", 3.8))
#: What isn't a secret however it looks: addresses up to their query, mail addresses, UUIDs, named digests and commits,
#: alphabets, and strings that say that they are examples.
ALLOWED = (
    r"https?://[^\s?#\"'<>]+",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])",
    r"(?:sha(?:1|224|256|384|512)|md5)[:=-]\x20?[0-9A-Za-z+/=]+",
    r"commit\x20[0-9a-f]{40}(?![0-9A-Za-z])",
    r"(?:ABCDEFGHIJKLMNOPQRSTUVWXYZ|abcdefghijklmnopqrstuvwxyz|0123456789)+(?:\+/)?",
    r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]*(?:EXAMPLE|example|PLACEHOLDER|placeholder|CHANGEME|changeme)[0-9A-Za-z+/_=-]*",
)
#: n log2(n), as whole numbers, so that sums kept by adding and taking away are those of counting anew.
SCALE = 1 << 40
Span = tuple[str, int, int]


def weight(n: int) -> int:
    return round(n * math.log2(n) * SCALE) if n else 0


def dense_windows(text: str, width: int, bits: float) -> list[tuple[int, int]]:
    """Spans of the windows of `width` characters whose Shannon entropy is `bits` a character or more and that have a digit and a
    letter; those that overlap or touch are one span.

    Counts are kept while the window slides: one character enters, one leaves, and the sum of n log2(n) changes by four terms.
    """
    if len(text) < width:
        return []
    weights = [weight(n) for n in range(width + 2)]
    most = math.floor(width * (math.log2(width) - bits) * SCALE + width / 2)  # of the sum; each weight is rounded by a half at most
    counts, held, digits, letters, out = dict.fromkeys(text, 0), 0, 0, 0, []
    for i, c in enumerate(text):
        n = counts[c]
        counts[c], held = n + 1, held + weights[n + 1] - weights[n]
        digits, letters = digits + c.isdigit(), letters + c.isalpha()
        if i >= width:
            c = text[i - width]
            n = counts[c]
            counts[c], held = n - 1, held + weights[n - 1] - weights[n]
            digits, letters = digits - c.isdigit(), letters - c.isalpha()
        if i >= width - 1 and held <= most and digits and letters:
            start = i - width + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """The base kinds' matches, leftmost and without overlaps in each kind, by start, then kind; an assignment's match is all of it."""
    found: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


class Scanner:
    """Finds spans: the base kinds, then those that windows of high entropy add."""

    def __init__(self, width: int = WIDTH, classes: Sequence[tuple[str, str, float]] = CLASSES, allowed: Sequence[str] = ALLOWED):
        self.width = width
        self.classes = [(name, re.compile(f"[{made_of}]{{{width},}}"), bits) for name, made_of, bits in classes]
        self.order = {k: i for i, k in enumerate([*BASE, *(c[0] for c in classes)])}
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None

    def __call__(self, text: str) -> list[Span]:
        found = base_spans(text)
        covered, harmless = sorted(s[1:] for s in found), None
        for name, candidates, bits in self.classes:
            own = []
            for m in candidates.finditer(text):
                for start, end in dense_windows(m[0], self.width, bits):
                    own.append((start + m.start(), end + m.start()))
            if own and harmless is None:
                harmless = [m.span() for m in self.allowed.finditer(text)] if self.allowed else []
            own = outside(outside(own, covered), harmless or [])
            found += [(name, *s) for s in own]
            covered = sorted([*covered, *own])
        return sorted(found, key=lambda s: (s[1], self.order[s[0]], s[2]))


def outside(spans: list[tuple[int, int]], of: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, in order, that don't lie within one of `of` (in order of starts)."""
    out, i, reach = [], 0, -1
    for start, end in spans:
        while i < len(of) and of[i][0] <= start:
            reach, i = max(reach, of[i][1]), i + 1
        if end > reach:
            out.append((start, end))
    return out


def scan(docs: DataFrame, width: int = WIDTH, classes: Sequence[tuple[str, str, float]] = CLASSES, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """doc_id and `spans` (kind, start, end: code points, end exclusive) of every row, by start, then kind in the order listed.

    Entropy's spans are those of each class in turn that don't lie within a base span, a span of an earlier class or what the
    allow-list matches; the allow-list never takes a base span away. Null texts count as empty and have no spans; whole texts
    are read. Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Scanner(width, classes, allowed)
        for b in batches:
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in found(t)] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(rows, spans)], ["doc_id", "spans"])

    return in_arrow(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), work, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping or touching spans replaced by `mark`."""
    piece = "struct<kept: string, at: bigint>"
    whole = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")).cast(piece),
        lambda s, x: F.when(
            x["start"] >= s["at"], F.struct(F.concat(s["kept"], F.substr(text, s["at"].cast("int") + 1, (x["start"] - s["at"]).cast("int")), F.when((x["start"] == s["at"]) & (s["at"] > 0), "").otherwise(mark)).alias("kept"), x["end"].alias("at"))
        )
        .otherwise(F.struct(s["kept"].alias("kept"), F.greatest(s["at"], x["end"]).alias("at")))
        .cast(piece),
    )
    return F.get(F.transform(F.array(whole), lambda s: F.concat(s["kept"], F.substr(text, s["at"].cast("int") + 1))), 0)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts of the base kinds, a digest of their spans, and all spans."""
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return scan(table(spark, sf_dir, "documents")).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))

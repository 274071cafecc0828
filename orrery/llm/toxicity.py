"""Toxicity: a weighted lexicon found by an Aho-Corasick automaton in folded text, less exception phrases, by length."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow, table, written
from .labelled import fold, sample

HELD_OUT, THRESHOLD = 3, 0.7
#: The bound of labelled rows that the lexicon is learned from.
SAMPLE = 8_000
#: Entries are whole words, or word beginnings of SHORTEST to LONGEST letters; an entry is in so many toxic texts at least, its share of all
#: words is so many times higher in toxic texts, the log likelihood ratio of its texts is so large that chance makes none among
#: all entries, and it is so much heavier than its own beginning.
SHORTEST, LONGEST, SUPPORT, TIMES, RATIO, MORE = 4, 14, 5, 4.0, 18.0, 1.3

# Letters of other scripts that look like Latin ones (Unicode confusables), and digits and signs used as letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "ԛ": "q", "ԝ": "w", "г": "r", "ё": "e",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "s", "ł": "l", "ø": "o", "đ": "d",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "+": "t", "€": "e"}
INVISIBLE = "­​‌‍⁠﻿"

_signs = re.compile(f"[{re.escape(''.join(SUBSTITUTES))}]+")
_substitute = str.maketrans(SUBSTITUTES)
_word = re.compile(r"[^\W_]+")


class _Folds(dict):
    """Each character in lower case, without marks, in Latin letters where it looks like one; invisible ones go."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        plain = "".join(LOOKALIKES.get(c, c) for c in plain if not unicodedata.combining(c) and c not in INVISIBLE)
        self[code] = plain
        return plain


_folds = _Folds()


def _letters(m: re.Match) -> str:
    """Digits and signs as letters, if a letter follows; or without signs of punctuation, if one goes before."""
    text, (begin, end) = m.string, m.span()
    if text[end : end + 1].isalpha() or begin and text[begin - 1].isalpha() and not set("!|+€") & set(m[0]):
        return m[0].translate(_substitute)
    return m[0]


def folded(text: str) -> str:
    """The text's words in folded letters, each after one space, with one space at the end."""
    text = text.translate(_folds)
    text = _signs.sub(_letters, text)
    return f" {' '.join(_word.findall(text))} "


@dataclass
class Lexicon:
    """weights: entry -> weight, an entry begins with a space (a word's beginning) and may end with one (a whole word).

    exceptions: phrases in which an entry doesn't count. slope and bias make scores of weights by length.
    """

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: tuple[float, float] = (0.0, 0.0)
    bias: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0, True))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, text: str, automaton) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of entries in a folded text: of several that begin alike the heaviest, none inside an exception."""
        if not len(automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        spans = []
        for last, (size, weight, exception) in automaton.iter(text):
            begin = last + 1 - size
            if exception:
                spans.append((begin, last + 1))
            elif weight > best.get(begin, (0, 0.0))[1]:
                best[begin] = (last + 1, weight)
        out, spans, at, reach = [], sorted(spans), 0, 0
        for begin in sorted(best):
            end, weight = best[begin]
            while at < len(spans) and spans[at][0] <= begin:
                reach, at = max(reach, spans[at][1]), at + 1
            if end > reach:
                out.append((begin, end, weight))
        return out

    def measures(self, text: str, automaton) -> tuple[float, float]:
        """Weight per word, and weight by the root of words: a text's evidence at either scale of length."""
        text = folded(text)
        words = max(1, text.count(" ") - 1)
        total = sum(w for _, _, w in self.hits(text, automaton))
        return total / words, total / words**0.5

    def score(self, measures: tuple[float, float]) -> float:
        z = self.bias + sum(s * np.log1p(20 * m) for s, m in zip(self.slope, measures, strict=True))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


WORDS = ""  # stands for all words of a text


def entries_of(text: str) -> Counter:
    """How often words, of any length, and word beginnings of up to LONGEST letters are in a folded text."""
    out: Counter = Counter()
    for w, n in Counter(text.split()).items():
        out[WORDS] += n
        out[f" {w} "] += n
        for size in range(SHORTEST, min(len(w), LONGEST) + 1):
            out[f" {w[:size]}"] += n
    return out


def _rows(b: pa.RecordBatch) -> Iterator[tuple[str, int]]:
    return zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True)


def learn(picked: DataFrame) -> Lexicon:
    """A lexicon from labelled rows (text, label), which are bounded; only counts of texts for each entry leave the executors.

    All entries and exceptions that pass are kept: each is in SUPPORT texts of the sample at least, so the sample bounds them.
    """
    picked = picked.select(F.coalesce("text", F.lit("")).alias("text"), "label")

    columns = ("clean", "toxic", "clean_n", "toxic_n")
    counts_of = pa.schema([("entry", pa.string()), *((c, pa.int64()) for c in columns)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, times = (Counter(), Counter()), (Counter(), Counter())
            for text, label in _rows(b):
                found = entries_of(folded(text))
                texts[label].update(found.keys())
                times[label].update(found)
            for y in (0, 1):
                yield pa.RecordBatch.from_pydict({"entry": list(texts[y]), "clean": [n * (1 - y) for n in texts[y].values()], "toxic": [n * y for n in texts[y].values()], "clean_n": [n * (1 - y) for n in times[y].values()], "toxic_n": [n * y for n in times[y].values()]}, counts_of)

    clean, toxic = (picked.filter(F.col("label") == x).count() for x in (0, 1))
    if not toxic or not clean:
        return Lexicon()
    counts = in_arrow(picked, count, "entry string, " + ", ".join(f"{c} long" for c in columns)).groupBy("entry").agg(*(F.sum(c).alias(c) for c in columns))
    clean_words, toxic_words = (r or 1 for r in counts.filter(F.col("entry") == WORDS).agg(F.sum("clean_n"), F.sum("toxic_n")).first())
    odds = F.log((F.col("toxic_n") + 0.5) / toxic_words * clean_words / (F.col("clean_n") + 0.5))
    share = toxic / (clean + toxic)
    part = F.col("toxic") / (F.col("clean") + F.col("toxic"))
    ratio = F.col("toxic") * F.log(part / share) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    found = counts.filter((F.col("entry") != WORDS) & (F.col("toxic") >= SUPPORT) & (part > share)).withColumn("odds", odds).filter((ratio >= RATIO) & (F.col("odds") >= math.log(TIMES)))
    got = found.select("entry", "odds").toPandas()
    weights: dict[str, float] = {}
    for entry, odds in sorted(zip(got.entry, got.odds, strict=True), key=lambda x: (len(x[0].rstrip()), x[0])):
        shorter = max((weights.get(entry[:n], 0.0) for n in range(SHORTEST + 1, len(entry))), default=0.0)
        if odds > MORE * shorter:
            weights[entry] = float(odds)
    lexicon = Lexicon(weights)

    def context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            seen: Counter = Counter()
            for text, label in _rows(b):
                text = folded(text)
                phrases = set()
                for begin, end, _ in lexicon.hits(text, automaton):
                    stop = text.find(" ", max(end - 1, begin + 1)) + 1
                    before, after = text.rfind(" ", 0, begin), text.find(" ", stop) + 1
                    phrases |= {text[before:stop] if before >= 0 else "", text[begin:after] if after else ""} - {""}
                seen.update((p, int(label)) for p in phrases)
            yield pa.RecordBatch.from_pydict({"phrase": [p for p, _ in seen], "clean": [n * (1 - y) for (_, y), n in seen.items()], "toxic": [n * y for (_, y), n in seen.items()]}, pa.schema([("phrase", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))

    spared = in_arrow(picked, context, "phrase string, clean long, toxic long").groupBy("phrase").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    lexicon.exceptions = [r.phrase for r in spared.filter((F.col("clean") >= SUPPORT) & (F.col("toxic") * (TIMES * clean / toxic) < F.col("clean"))).orderBy("phrase").collect()]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            found = [(*lexicon.measures(t, automaton), y) for t, y in _rows(b)]
            yield pa.RecordBatch.from_pydict({c: [x[i] for x in found] for i, c in enumerate(("a", "b", "label"))}, pa.schema([("a", pa.float64()), ("b", pa.float64()), ("label", pa.int32())]))

    rows = in_arrow(picked, measure, "a double, b double, label int").toPandas().sort_values(["label", "a", "b"])
    x, y = np.log1p(20 * rows[["a", "b"]].to_numpy()), rows.label.to_numpy()
    weigh = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(3)
    xs = np.column_stack([x, np.ones(len(x))])
    for _ in range(30):  # Newton's method on the ridge-regularised log loss
        p = 1 / (1 + np.exp(-np.clip(xs @ w, -30, 30)))
        g = xs.T @ (weigh * (p - y)) + 1e-4 * w
        h = (xs * (weigh * p * (1 - p))[:, None]).T @ xs + 1e-4 * np.eye(3)
        w -= np.linalg.solve(h, g)
    lexicon.slope, lexicon.bias = (float(w[0]), float(w[1])), float(w[2])
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds the score of each row's whole text; a column of that name is replaced, all others pass untouched."""
    docs = docs.drop("score")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            scores = [lexicon.score(lexicon.measures(t.as_py() or "", automaton)) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, "score"])

    return in_arrow(docs, work, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Held out are rows whose crc32(doc_id as text) mod 3 is 1: their labels teach nothing. A null doc_id isn't held out; its
    label is never used. Null and empty texts have the score of a text without hits; repeated rows have equal scores; an
    empty table gives no rows; without labels of either kind every score is one half. Other columns are ignored.
    """
    held = fold(F.col("doc_id"), HELD_OUT) == 1
    lexicon = learn(written(docs.sparkSession, sample(docs, labels, "toxic", held, SAMPLE), "toxicity-sample"))
    scored = score(docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out")), lexicon)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

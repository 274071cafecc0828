"""Quality classifier: a factorisation machine over hashed words, statistics of a text's structure, and its lengths.

Score = sigmoid(bias + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): all pairwise interactions, of low
rank, in time linear in the features that a document has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import in_arrow, release, table, written
from .labelled import fold, sample

#: Slots for hashed words, rank of the interactions, and the bound of labelled rows that the model is fitted on.
SLOTS, RANK, SAMPLE = 1 << 14, 4, 3_000
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-5
#: Hashed words of all sampled texts together, at most: what the driver holds of them.
SAMPLE_SLOTS = 6_000_000
HELD_OUT, THRESHOLD = 5, 0.3

_KINDS = np.zeros(256, np.int64)  # 0: other marks
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:'\"()-", b"!?", b"|<>{}[]=/\\", b"*#$%&@^~_+`", b"\t\r\v\f"), 1):
    _KINDS[list(_chars)] = _k
_KINDS[128:] = 11
KINDS = 12
STATISTICS = KINDS + 7


@dataclass
class Features:
    """Sparse rows: statistics of each document, and (document, slot, value) of its hashed words with values of length 1."""

    statistics: np.ndarray
    doc: np.ndarray
    slot: np.ndarray
    value: np.ndarray


def features(part: tokens.Part) -> Features:
    n = part.docs
    found = tokens.words(part)
    h = tokens.word_hashes(part, found)
    size = np.diff(part.bounds)
    if n == 1:  # a text that may be long is counted block by block
        kinds = sum(np.bincount(_KINDS[part.data[at : at + tokens.PART_BYTES]], minlength=KINDS) for at in range(0, max(1, len(part.data)), tokens.PART_BYTES))[None]
    else:
        kinds = np.bincount(np.repeat(np.arange(n) * KINDS, size) + _KINDS[part.data], minlength=n * KINDS).reshape(n, KINDS)
    count = np.bincount(found.doc, minlength=n)
    key, times = np.unique(found.doc * SLOTS + (h & np.uint64(SLOTS - 1)).astype(np.int64), return_counts=True)
    doc, slot = key // SLOTS, key % SLOTS
    norm = np.sqrt(np.bincount(doc, times.astype(float) ** 2, minlength=n))
    run = found.doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + h
    distinct = np.bincount(found.doc[np.unique(run, return_index=True)[1]], minlength=n)
    per = lambda x, y: x / np.maximum(y, 1)
    width = np.bincount(found.doc, found.end - found.start, minlength=n)
    shares = per(kinds, size[:, None])
    extra = np.stack([np.log1p(size), np.log1p(count), per(width, count), per(distinct, count), per(times_max(doc, times, n), count), per(kinds[:, 5], np.log1p(count)), (count == 0).astype(float)], 1)
    return Features(np.concatenate([np.sqrt(shares), extra], 1), doc, slot, times / norm[doc])


def times_max(doc: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """The largest count of a slot in each document."""
    out = np.zeros(n)
    np.maximum.at(out, doc, times)
    return out


@dataclass
class Model:
    """Features are the slots, then the statistics, centred and scaled by those of the sample."""

    centre: np.ndarray
    scale: np.ndarray
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def rows(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, feature, value) of all features, in the order of documents."""
        n = len(f.statistics)
        z = np.clip((f.statistics - self.centre) / self.scale, -4, 4) / 4
        doc = np.concatenate([f.doc, np.repeat(np.arange(n), STATISTICS)])
        feature = np.concatenate([f.slot, np.tile(np.arange(SLOTS, SLOTS + STATISTICS), n)])
        return doc, feature, np.concatenate([f.value, z.ravel()])

    def scores(self, f: Features) -> np.ndarray:
        n = len(f.statistics)
        doc, feature, x = self.rows(f)
        total = self.bias + np.bincount(doc, self.weight[feature] * x, minlength=n)
        for v in self.factors.T:
            vx = v[feature] * x
            total += 0.5 * (np.bincount(doc, vx, minlength=n) ** 2 - np.bincount(doc, vx * vx, minlength=n))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(rows: list[tuple[Features, int]]) -> Model:
    """Fits the machine by AdaGrad on log loss, either label weighing as much. Without rows every score is one half."""
    m = SLOTS + STATISTICS
    rng = np.random.default_rng(7)
    if not rows:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), 0.0, np.zeros(m), np.zeros((m, RANK)))
    all_stats = np.concatenate([f.statistics for f, _ in rows])
    model = Model(all_stats.mean(0), all_stats.std(0) + 1e-6, 0.0, np.zeros(m), rng.normal(0, 0.02, (m, RANK)))
    y = np.array([label for _, label in rows], float)
    weigh = np.where(y > 0, len(y) / max(1, 2 * y.sum()), len(y) / max(1, 2 * (len(y) - y.sum())))
    sparse = [model.rows(f)[1:] for f, _ in rows]
    seen_w, seen_v, seen_b = np.full(m, 1e-2), np.full((m, RANK), 1e-2), 1e-2
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            doc = np.repeat(np.arange(len(some)), [len(sparse[i][0]) for i in some])
            feature, x = (np.concatenate([sparse[i][k] for i in some]) for k in (0, 1))
            v = model.factors[feature]
            vx = v * x[:, None]
            sums = np.stack([np.bincount(doc, c, minlength=len(some)) for c in vx.T], 1)
            raw = model.bias + np.bincount(doc, model.weight[feature] * x, minlength=len(some)) + 0.5 * ((sums**2).sum(1) - np.bincount(doc, (vx * vx).sum(1), minlength=len(some)))
            g = weigh[some] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[some])
            slots, where = np.unique(feature, return_inverse=True)
            gw = np.bincount(where, g[doc] * x, minlength=len(slots)) + DECAY * model.weight[slots]
            gv = np.stack([np.bincount(where, g[doc] * x * (sums[doc, k] - vx[:, k]), minlength=len(slots)) for k in range(RANK)], 1) + DECAY * model.factors[slots]
            seen_w[slots] += gw**2
            seen_v[slots] += gv**2
            seen_b += g.sum() ** 2
            model.weight[slots] -= RATE * gw / np.sqrt(seen_w[slots])
            model.factors[slots] -= RATE * gv / np.sqrt(seen_v[slots])
            model.bias -= RATE * g.sum() / np.sqrt(seen_b)
    return model


FEATURES = "label int, statistics array<double>, slot array<int>, value array<double>"


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Features are made on the executors from whole texts; only those of the bounded sample come to the driver.

    Where the sample's texts have more than SAMPLE_SLOTS different hashed words together, as many of them as fit are taken, in
    an order by hash that has nothing to do with their labels or lengths.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.int32()), ("statistics", pa.list_(pa.float64())), ("slot", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))])
        for b in batches:
            for part in tokens.parts(b.column("text")):
                f = features(part)
                cut = np.searchsorted(f.doc, np.arange(part.docs + 1))
                each = [(f.slot[a:z], f.value[a:z]) for a, z in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([b.column("label").slice(part.rows.start, part.docs), pa.array(list(f.statistics), schema[1].type), pa.array([x.astype(np.int32) for x, _ in each], schema[2].type), pa.array([x for _, x in each], schema[3].type)], schema=schema)

    picked = sample(docs, labels, "quality", fold(F.col("doc_id"), HELD_OUT) == 0, SAMPLE)
    made = written(docs.sparkSession, in_arrow(picked, work, FEATURES).withColumn("order", F.xxhash64("slot", "value")), "quality-features")
    sizes = made.select("order", F.size("slot").alias("n")).toPandas().sort_values("order")
    fits = sizes.n.cumsum() <= SAMPLE_SLOTS
    got = (made if fits.all() else made.filter(F.col("order").isin(sizes.order[fits].tolist()))).drop("order").toPandas()
    rows = [(Features(np.stack([s]), np.zeros(len(i), int), np.asarray(i, np.int64), np.asarray(x, float)), int(y)) for y, s, i, x in zip(got.label, got.statistics, got["slot"], got["value"], strict=True)]
    model = fit(sorted(rows, key=lambda r: (r[1], r[0].statistics.tobytes())))
    del made, sizes, got, rows
    release()  # the driver keeps the model alone
    return model


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Adds the score of each row's whole text; a null text counts as empty. A column of that name is replaced, all others pass untouched."""
    docs = docs.drop(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.scores(features(p)) for p in tokens.parts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*b.schema.names, column])

    return in_arrow(docs, work, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Held out are rows whose crc32(doc_id as text) mod 5 is 0: their labels teach nothing. A null doc_id is not held out; its
    label is never used. Empty and null texts have scores like any; repeated rows have equal scores; an empty table gives no
    rows, and without labels every score is one half. Other columns are ignored.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), HELD_OUT) == 0, F.lit(False)).alias("held_out")
    scored = score(docs.select("doc_id", "text"), train(docs, labels)).select("doc_id", held_out, "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

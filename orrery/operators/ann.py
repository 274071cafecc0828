"""An approximate vector index: coarse centroids, a list of vectors for each, the nearest lists probed, and exact re-ranking.

Centroids are learned by grouped means over a bounded sample. The vectors are stored in one partition for each list, so a
search reads the folders of the lists that it probes and no others. Scope, status and visibility are filtered before anything is ranked, and distances are the exact search's.
What is approximate is which lists are read: probing all of them is the exact search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidConfig
from ..functions import exprs as X
from ..sources.shared import written
from . import blocks, search
from .search import SearchRequest

#: Bytes of all centroids: they go to every task.
CENTROID_BYTES = 64 << 20


@dataclass(frozen=True)
class IndexConfig:
    """lists: how many, at most; sample: vectors for each that centroids are learned from; rounds of means; least share of lists that a search probes."""

    dimensions: int
    lists: int = 64
    sample: int = 64
    rounds: int = 6

    def __post_init__(self) -> None:
        if self.dimensions < 1 or self.lists < 1 or self.sample < 1 or self.rounds < 0 or self.lists * self.dimensions * 8 > CENTROID_BYTES:
            raise InvalidConfig("the index has no lists or dimensions, or its centroids are too many to send to every task")


def unit(vectors: np.ndarray) -> np.ndarray:
    lengths = blocks.norms(vectors)
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None]


def nearest_lists(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """For each vector the numbers of the n nearest centroids, the nearest first, of equal ones the smaller number."""
    return np.argsort(-(unit(vectors) @ centroids.T).round(12), axis=1, kind="stable")[:, :n]


def sampled(vectors: DataFrame, most: int) -> DataFrame:
    """About `most` rows, chosen by a hash of their ids: the same ones each time."""
    share = min(1.0, most / max(1, vectors.count()))
    return vectors.filter(F.pmod(F.xxhash64("chunk_set_id", "chunk_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def learned(spark: SparkSession, vectors: DataFrame, config: IndexConfig) -> np.ndarray:
    """Centroids of length 1, at most `config.lists`: some distinct vectors of a sample, moved to the means of what is nearest to them.

    A task gives a sum and a count for each centroid that it met; Spark sums those by centroid and dimension. The driver gets
    the centroids alone. A centroid that nothing is nearest to stays where it is.
    """
    rows = vectors.select("chunk_set_id", "chunk_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter((F.size("embedding") == config.dimensions) & X.finite(F.col("embedding")) & (X.norm(F.col("embedding")) > 0))
    sample = written(spark, sampled(rows, config.lists * config.sample), "index-sample")
    # A few times as many as needed, so that copies leave enough; distinct ones, in an order that has nothing to do with them.
    first = sample.select("embedding", F.xxhash64("embedding").alias("h")).distinct().orderBy("h").limit(config.lists).toArrow()
    if not len(first):
        raise InvalidConfig("there are no vectors to learn from")
    centroids = unit(np.array(first["embedding"].to_pylist(), np.float64))
    for _ in range(config.rounds):
        sums = sample.select("embedding").mapInArrow(_sums(centroids), "list int, n long, total array<double>")
        means = sums.select("list", "n", F.posexplode("total").alias("at", "x")).groupBy("list", "at").agg(F.sum("x").alias("x")).toArrow()
        moved = centroids.copy()
        moved[means["list"].to_numpy(), means["at"].to_numpy()] = means["x"].to_numpy()
        centroids = unit(np.where((np.abs(moved).sum(axis=1) > 0)[:, None], moved, centroids))
    return centroids


def _sums(centroids: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for b in batches:
            _, vectors = blocks.matrix(b["embedding"], centroids.shape[1])
            at = nearest_lists(vectors, centroids, 1)[:, 0]
            np.add.at(total, at, unit(vectors))
            n += np.bincount(at, minlength=len(n))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(n[met]), pa.array(list(total[met]), pa.list_(pa.float64()))], ["list", "n", "total"])

    return work


def listed(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors with the number of their list, all other columns untouched; those without a direction have none and go."""
    held = vectors.sparkSession.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = blocks.matrix(b["embedding"], held.value.shape[1])
            lengths = blocks.norms(rows)
            some = np.flatnonzero((lengths > 0) & np.isfinite(lengths))
            of = nearest_lists(rows[some], held.value, 1)[:, 0] if len(some) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(at[some])).columns, pa.array(of, pa.int32())], [*b.schema.names, "list"])

    return vectors.mapInArrow(work, vectors.withColumn("list", F.lit(0)).schema)


class VectorIndex:
    """Vectors on disk by list, and the centroids: `build` writes them, `load` reads what was written."""

    def __init__(self, spark: SparkSession, path: str, centroids: np.ndarray):
        self.spark, self.path, self.centroids = spark, path, centroids

    @property
    def lists(self) -> int:
        return len(self.centroids)

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @classmethod
    def build(cls, vectors: DataFrame, path: str, config: IndexConfig) -> VectorIndex:
        """Indexes every vector (chunk_set_id, chunk_id, model_key, embedding, searchable) that has a direction.

        Rows are dealt by list; a list with very many rows is split over tasks and files as it is written.
        """
        spark = vectors.sparkSession
        rows = vectors.select("chunk_set_id", "chunk_id", "model_key", F.col("embedding").cast("array<float>").alias("embedding"), "searchable")
        centroids = learned(spark, rows, config)
        listed(rows, centroids).hint("rebalance", "list").sortWithinPartitions("list", "model_key", "chunk_set_id").write.partitionBy("list").parquet(f"{path}/vectors")
        spark.createDataFrame([(i, c) for i, c in enumerate(centroids.tolist())], "list int, centroid array<double>").coalesce(1).write.parquet(f"{path}/centroids")
        return cls(spark, path, centroids)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VectorIndex:
        rows = spark.read.parquet(f"{path}/centroids").orderBy("list").toArrow()
        return cls(spark, path, np.array(rows["centroid"].to_pylist(), np.float64))

    def search(self, sets: DataFrame, request: SearchRequest, probes: int) -> DataFrame:
        """The nearest visible vectors in the request's scope and model space, as the exact search ranks them.

        The nearest `probes` lists are read. As long as they hold fewer visible vectors than are asked for, twice as many are
        read, in the end all: a small scope never loses results to the vectors of others.
        """
        query = np.array([request.vector], np.float64)
        order = nearest_lists(query, self.centroids, self.lists)[0].tolist()
        scope = (F.col("tenant_id") == request.tenant_id) & (F.col("knowledge_base_id") == request.knowledge_base_id)
        while True:
            near = self.vectors.filter(F.col("list").isin(order[:probes]) & (F.col("model_key") == request.model_key))
            found = search.ranked(search.visible(sets.filter(scope), near), request.vector, request.limit)
            if probes >= self.lists:
                return found
            rows = found.collect()
            if len(rows) == request.limit:
                return self.spark.createDataFrame(rows, found.schema)
            probes *= 2

    def probes_for(self, queries: DataFrame, sets: DataFrame, limit: int, target: float = 0.95) -> int:
        """How many lists of each query must be read so that `target` of the exact search's rows are in them, measured for these queries.

        The queries are a bounded sample of those to come. How many lists it takes is up to the vectors: few where they lie in
        clusters, half of them and more where they lie evenly in all directions.
        """
        dimensions = self.centroids.shape[1]
        exact = blocks.search_blocks(queries, search.visible(sets, self.vectors), limit, dimensions)
        rows = exact.join(self.vectors.select("chunk_set_id", "chunk_id", "list"), ["chunk_set_id", "chunk_id"]).join(queries.select("query_id", "vector"), "query_id").select("list", F.col("vector").cast("array<double>").alias("vector")).toArrow()
        if not len(rows):
            return self.lists
        order = nearest_lists(np.array(rows["vector"].to_pylist(), np.float64), self.centroids, self.lists)
        places = np.sort(np.argmax(order == rows["list"].to_numpy()[:, None], axis=1))
        return int(places[math.ceil(target * len(places)) - 1]) + 1

    def search_many(self, queries: DataFrame, sets: DataFrame, limit: int, probes: int) -> DataFrame:
        """query_id, rank, chunk_set_id, chunk_id, cosine_distance for queries (query_id, model_key, vector), a stated set.

        Each query is sent to its nearest lists, and only folders of lists that a query is sent to are read. Queries go to the
        tasks in blocks; there those with the same list meet its vectors in products of matrices.
        """
        columns = ("model_key", "tenant_id", "knowledge_base_id") if "tenant_id" in queries.columns else ("model_key",)
        sent = probed(queries.select("vector"), self.centroids, probes)
        met = [r[0] for r in sent.select("list").distinct().collect()]
        seen = search.visible(sets, self.vectors.filter(F.col("list").isin(met)))
        centroids = self.centroids
        return blocks.nearest(queries, seen, limit, centroids.shape[1], None if probes >= self.lists else lambda vectors: nearest_lists(vectors, centroids, probes), columns)


def probed(queries: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """A row for each query and each of its nearest lists; queries without a direction have none."""
    held = queries.sparkSession.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = blocks.matrix(b["vector"], held.value.shape[1])
            if not len(at):
                continue
            of = nearest_lists(rows, held.value, probes)
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(np.repeat(at, of.shape[1]))).columns, pa.array(of.ravel(), pa.int32())], [*b.schema.names, "list"])

    return queries.mapInArrow(work, queries.withColumn("list", F.lit(0)).schema)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """query_id, wanted and hits: how many of the exact search's rows of each query the other search has."""
    keys = ["query_id", "chunk_set_id", "chunk_id"]
    joined = exact.select(*keys).join(found.select(*keys).withColumn("hit", F.lit(1)), keys, "left")
    return joined.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("hit").alias("hits"))

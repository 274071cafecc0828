"""Blocks of vectors in Arrow batches: distances by matrix products, the nearest of each query kept in each task.

A product of matrices finds what may be among the nearest, within an error that rounding can't exceed; the distances of those
few are then summed in the order in which the SQL functions of `exprs` sum, so both give the same numbers and equal vectors
tie exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import in_batches

#: Bytes of query vectors that a block of queries has at most, and of a matrix of products.
BLOCK_BYTES, PRODUCT_BYTES = 16 << 20, 32 << 20
#: Rows that a first product is made of: what it finds bounds what is looked at in the others.
FIRST = 64
#: Pairs whose distances are summed at once.
PAIRS = 16_384
#: More than two ways to sum the same products of up to some thousand 32-bit floats can differ in a distance.
SLACK = 1e-9


def matrix(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that have so many numbers and no null, and their vectors as 64-bit floats."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dimensions)
    chosen = column.take(pa.array(rows))
    flat = chosen.flatten()
    if flat.null_count:
        whole = np.asarray(flat.is_valid()).reshape(len(rows), dimensions).all(axis=1)
        return matrix_at(column, rows[whole], dimensions)
    return rows, flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dimensions)


def matrix_at(column: pa.Array, rows: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    return rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dimensions)


def in_order(products: np.ndarray) -> np.ndarray:
    """Sums of rows from left to right, as a loop would sum them."""
    return np.add.accumulate(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(in_order(vectors * vectors))


def exact(vectors: np.ndarray, lengths: np.ndarray, queries: np.ndarray, query_lengths: np.ndarray) -> np.ndarray:
    """The distances of pairs, row by row."""
    return np.clip(1 - in_order(vectors * queries) / (lengths * query_lengths), 0.0, 2.0)


class Nearest:
    """The `limit` nearest rows seen so far of each of `n` queries, by distance, set and chunk.

    Distances are in arrays, for all queries at once; names are kept of rows that are among the nearest of a query.
    """

    def __init__(self, limit: int, n: int):
        self.limit = limit
        self.distance = np.full((n, limit), np.inf)
        self.names = np.full((n, limit), None, dtype=object)

    @property
    def bound(self) -> np.ndarray:
        return self.distance[:, -1]

    def add(self, query: np.ndarray, distance: np.ndarray, names: list[tuple[str, str]]) -> None:
        """Rows in the order of their queries; those of one query may be any number."""
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(query)], strict=True):
            i = query[a]
            held = [x for x in zip(self.distance[i].tolist(), self.names[i].tolist(), strict=True) if x[1] is not None]
            best = sorted([*held, *zip(distance[a:z].tolist(), names[a:z], strict=True)])[: self.limit]
            self.distance[i, : len(best)] = [d for d, _ in best]
            for k, (_, name) in enumerate(best):
                self.names[i, k] = name


def search_blocks(queries: DataFrame, candidates: DataFrame, limit: int, dimensions: int) -> DataFrame:
    """query_id, rank, chunk_set_id, chunk_id and cosine_distance of the `limit` nearest candidates of each query in its model space.

    The same rows as `search.search_many`, for long vectors. Queries (query_id, model_key, vector) are a stated set and go to
    the executors in blocks of at most BLOCK_BYTES, each with a pass over the candidates. A task gives `limit` rows for each
    query. Vectors of other dimensions or of length zero are never found; NaN isn't either.
    """
    return nearest(queries, candidates, limit, dimensions)


def nearest(queries: DataFrame, candidates: DataFrame, limit: int, dimensions: int, lists: Callable[[np.ndarray], np.ndarray] | None = None, columns: tuple[str, ...] = ("model_key",)) -> DataFrame:
    """`search_blocks`; with `lists` (the numbers of the lists that each vector is sent to) among candidates of the query's lists alone.

    A query meets candidates whose values of `columns` are its own.
    """
    spark = candidates.sparkSession
    asked = queries.select("query_id", *columns, F.col("vector").cast("array<double>").alias("vector")).filter(F.size("vector") == dimensions)
    kind = queries.schema["query_id"].dataType.simpleString()
    count = asked.count()
    blocks = max(1, -(-count * dimensions * 8 // BLOCK_BYTES))
    out = None
    for k in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k).toArrow()
        vectors = np.array(rows["vector"].to_pylist(), np.float64).reshape(len(rows), dimensions)
        spaces = list(zip(*(rows[c].to_pylist() for c in columns), strict=True))
        held = spark.sparkContext.broadcast((rows["query_id"].combine_chunks(), spaces, vectors, None if lists is None else lists(vectors)))
        own = [*columns, "chunk_set_id", "chunk_id", "embedding", *([] if lists is None else ["list"])]
        found = in_batches(candidates.select(*own), _task(held, limit, dimensions, columns), f"query_id {kind}, chunk_set_id string, chunk_id string, cosine_distance double")
        out = found if out is None else out.union(found)
    order = Window.partitionBy("query_id").orderBy("cosine_distance", "chunk_set_id", "chunk_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit).select("query_id", "rank", "chunk_set_id", "chunk_id", "cosine_distance")


def _task(held, limit: int, dimensions: int, columns: tuple[str, ...]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, spaces, wanted, lists = held.value
        lengths = norms(wanted)
        direct = lengths > 0
        of: dict[tuple, list[int]] = {}  # queries by what candidates must be equal in
        for i in np.flatnonzero(direct).tolist():
            if None not in spaces[i]:
                for n in [()] if lists is None else [(int(x),) for x in lists[i]]:
                    of.setdefault(spaces[i] + n, []).append(i)
        groups = {k: np.array(v) for k, v in of.items()}
        near = Nearest(limit, len(ids))
        keys = columns if lists is None else (*columns, "list")
        for batch in batches:
            at, vectors = matrix(batch["embedding"], dimensions)
            own = norms(vectors)
            at, vectors, own = at[own > 0], vectors[own > 0], own[own > 0]
            rows_of: dict[tuple, list[int]] = {}
            for j, key in enumerate(zip(*(batch[c].take(pa.array(at)).to_pylist() for c in keys), strict=True)):
                rows_of.setdefault(key, []).append(j)
            for key, rows in rows_of.items():
                if key in groups:
                    _product(batch, at, vectors, own, np.array(rows), groups[key], wanted, lengths, near)
        query, place = np.nonzero(np.isfinite(near.distance))
        names = near.names[query, place]
        columns_ = [pa.array([n[j] for n in names], pa.string()) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(query)), *columns_, pa.array(near.distance[query, place])], ["query_id", "chunk_set_id", "chunk_id", "cosine_distance"])

    return work


def _product(batch: pa.RecordBatch, at: np.ndarray, vectors: np.ndarray, own: np.ndarray, rows: np.ndarray, queries: np.ndarray, wanted: np.ndarray, lengths: np.ndarray, near: Nearest) -> None:
    """The rows against the queries, some rows at a time: for each of all pairs a product, for those that may be among the nearest the distance."""
    step = max(1, PRODUCT_BYTES // (8 * len(queries)))
    sets, chunks = batch["chunk_set_id"], batch["chunk_id"]
    asked = wanted[queries] / lengths[queries][:, None]
    start = 0
    while start < len(rows):
        some = rows[start : start + (min(step, FIRST) if not start else step)]
        start += len(some)
        with np.errstate(all="ignore"):
            rough = 1 - asked @ (vectors[some] / own[some][:, None]).T
        bound = near.bound[queries]
        if len(some) > near.limit and not np.isfinite(bound).all():
            bound = np.fmin(bound, np.partition(rough, near.limit - 1, axis=1)[:, near.limit - 1])
        q, r = np.nonzero(rough <= bound[:, None] + SLACK)
        if not len(q):
            continue
        chosen, query = some[r], queries[q]
        cuts = [slice(a, a + PAIRS) for a in range(0, len(q), PAIRS)]
        d = np.concatenate([exact(vectors[chosen[c]], own[chosen[c]], wanted[query[c]], lengths[query[c]]) for c in cuts])
        keep = np.flatnonzero((d <= near.bound[query]) & ~np.isnan(d))
        places = pa.array(at[chosen[keep]])
        near.add(query[keep], d[keep], list(zip(sets.take(places).to_pylist(), chunks.take(places).to_pylist(), strict=True)))

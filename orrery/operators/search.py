"""Exact cosine Top-K: every filter before the ranking, contents joined to the few rows that are left."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidEvidence, InvalidRequest
from ..functions import exprs as X
from ..functions.canonical import parse_object
from .blocks import search_blocks
from .ordering import numbered

MOST, QUERY_RUNES = 20, 4096
#: Rows of query vectors that are broadcast to the candidates.
BROADCAST_QUERIES = 10_000
EVIDENCE = "chunk_set_id chunk_id document_id source_uri source_name kind sequence content token_count source_unit_ids metadata cosine_distance".split()


@dataclass(frozen=True)
class SearchRequest:
    tenant_id: str
    knowledge_base_id: str
    model_key: str
    vector: list[float]
    limit: int
    dimensions: int = 1536

    def __post_init__(self) -> None:
        texts = (self.tenant_id, self.knowledge_base_id, self.model_key)
        if any(not t or t != t.strip() for t in texts) or not 1 <= self.limit <= MOST or len(self.vector) != self.dimensions:
            raise InvalidRequest("the search request is incomplete")
        if not all(abs(x) <= 3.4028234663852886e38 for x in self.vector):
            raise InvalidRequest("the query vector isn't finite")


def visible(sets: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Searchable vectors of active sets, with their set's scope. Sets are a small table; Spark broadcasts it while it is."""
    active = sets.filter("status = 'active'").select(F.col("id").alias("chunk_set_id"), "tenant_id", "knowledge_base_id", "document_id", "source_uri", "source_name")
    return embeddings.filter("searchable").join(active, "chunk_set_id")


def ranked(candidates: DataFrame, vector: list[float], limit: int) -> DataFrame:
    """The `limit` nearest, ties by set and chunk: candidates without a distance (zero vectors) are left out."""
    query = X.narrow(F.lit([float(x) for x in vector]))
    near = candidates.withColumn("cosine_distance", X.cosine_distance(F.col("embedding"), query)).filter("cosine_distance is not null")
    return near.drop("embedding").orderBy("cosine_distance", "chunk_set_id", "chunk_id").limit(limit)


def search(sets: DataFrame, chunks: DataFrame, embeddings: DataFrame, request: SearchRequest) -> DataFrame:
    scope = (F.col("tenant_id") == request.tenant_id) & (F.col("knowledge_base_id") == request.knowledge_base_id)
    found = visible(sets.filter(scope), embeddings.filter(F.col("model_key") == request.model_key).select("chunk_set_id", "chunk_id", "model_key", "embedding", "searchable"))
    top = ranked(found, request.vector, request.limit).select("chunk_set_id", "chunk_id", "document_id", "source_uri", "source_name", "cosine_distance")
    rows = chunks.select("chunk_set_id", "chunk_id", "kind", "sequence", "content", "token_count", "source_unit_ids", "metadata")
    return rows.join(F.broadcast(top), ["chunk_set_id", "chunk_id"]).select(*EVIDENCE).orderBy("cosine_distance", "chunk_set_id", "chunk_id")


def ranked_all(candidates: DataFrame, vector: list[float]) -> DataFrame:
    """rank, chunk_set_id, chunk_id and distance of all candidates of one query, the nearest first, numbered over range partitions."""
    query = X.narrow(F.lit([float(x) for x in vector]))
    near = candidates.select("chunk_set_id", "chunk_id", X.cosine_distance(F.col("embedding"), query).alias("cosine_distance")).filter("cosine_distance is not null")
    return numbered(near, ["cosine_distance", "chunk_set_id", "chunk_id"]).withColumnRenamed("number", "rank")


def search_many(queries: DataFrame, candidates: DataFrame, limit: int | None) -> DataFrame:
    """query_id, rank and distance of the nearest candidates of each query (query_id, vector) in its model space; all without a limit.

    Queries are a stated set. With a limit they are searched in blocks (`blocks.search_blocks`), those of each number of dimensions
    by themselves; vectors with NaN are never found. Without one, they are broadcast in blocks of at most BROADCAST_QUERIES, and norms are computed once a row.
    """
    if limit is not None:
        sizes = sorted(r[0] for r in queries.filter("vector is not null").select(F.size("vector")).distinct().collect()) or [1]
        return reduce(DataFrame.union, [search_blocks(queries, candidates, limit, n) for n in sizes if n] or [search_blocks(queries.filter("false"), candidates, limit, 1)])
    blocks = max(1, -(-queries.count() // BROADCAST_QUERIES))
    candidates, queries = candidates.withColumn("norm", X.norm(F.col("embedding"))), queries.withColumn("query_norm", X.norm(F.col("vector")))
    out = None
    for k in range(blocks):
        some = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == k)
        pairs = candidates.join(F.broadcast(some), "model_key").withColumn("cosine_distance", X.cosine_distance(F.col("embedding"), F.col("vector"), F.col("norm") * F.col("query_norm"))).filter("cosine_distance is not null")
        order = Window.partitionBy("query_id").orderBy("cosine_distance", "chunk_set_id", "chunk_id")
        found = pairs.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "chunk_set_id", "chunk_id", "cosine_distance")
        out = found if out is None else out.union(found)
    return out


def whole_evidence(r: dict) -> bool:
    """Whether a row of evidence has all it needs: texts that aren't blank, ids without white space at an end, numbers in range."""
    texts = [r[c] for c in ("chunk_set_id", "chunk_id", "document_id", "source_uri", "source_name", "kind", "content")]
    units = r["source_unit_ids"]
    if any(not isinstance(t, str) or not t.strip() for t in [*texts, *(units or [None])]) or any(t != t.strip() for t in texts[:2]):
        return False
    numbers = r["sequence"], r["token_count"], r["cosine_distance"]
    return None not in numbers and numbers[0] >= 1 and numbers[1] >= 0 and 0 <= numbers[2] <= 2 and parse_object(r["metadata"]) is not None


def validate_evidence(rows: list, limit: int) -> None:
    """Evidence as it is returned: at most `limit` rows in order, each one whole and once."""
    if len(rows) > limit:
        raise InvalidEvidence("too many rows")
    before = None
    for r in rows:
        if not whole_evidence(r):
            raise InvalidEvidence(f"{r['chunk_id']} isn't whole")
        key = (r["cosine_distance"], r["chunk_set_id"].encode(), r["chunk_id"].encode())
        if before is not None and key <= before:
            raise InvalidEvidence("rows are out of order or repeated")
        before = key

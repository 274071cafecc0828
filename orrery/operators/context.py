"""Hybrid results and what is given to a reader: two rankings fused by rank, children rolled up to parents, neighbours, a budget.

Everything here works on the few ranked rows of each query; the chunks are joined once for parents and once for neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = ["chunk_set_id", "chunk_id"]
#: The constant of reciprocal rank fusion; units of a score.
K, UNITS = 60, 1_000_000_000


def fused(*rankings: DataFrame, limit: int, k: int = K) -> DataFrame:
    """query_id, rank, chunk_set_id, chunk_id, score: a chunk's score is the sum of 1 / (k + rank) over the rankings that have it.

    Rankings (query_id, rank, chunk_set_id, chunk_id) meet in a full outer join, so a chunk that only one of them has stays.
    Scores are whole billionths; ties go by set and chunk. Ranks are compared, never distances with relevances.
    """
    keys = ["query_id", *CHUNK]
    out = None
    for i, r in enumerate(rankings):
        own = r.select(*keys, F.floor(F.lit(UNITS) / (F.col("rank") + k)).cast("long").alias(f"share {i}"))
        out = own if out is None else out.join(own, keys, "full")
    score = sum((F.coalesce(F.col(f"share {i}"), F.lit(0)) for i in range(1, len(rankings))), F.coalesce(F.col("share 0"), F.lit(0)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *CHUNK)
    return out.withColumn("score", score).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit).select("query_id", "rank", *CHUNK, "score")


def parents(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """query_id, rank, chunk_set_id, chunk_id, score, hits: each child's parent instead of it, by the best of its children's scores.

    A chunk without a parent stands for itself. Chunks are joined by set and chunk; nothing leaves a set.
    """
    above = chunks.select(*CHUNK, F.coalesce("parent_chunk_id", "chunk_id").alias("parent"))
    up = found.join(above, CHUNK).groupBy("query_id", "chunk_set_id", F.col("parent").alias("chunk_id")).agg(F.max("score").alias("score"), F.count("*").alias("hits"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *CHUNK)
    return up.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", *CHUNK, "score", "hits")


def with_neighbours(found: DataFrame, chunks: DataFrame, same: str = "section") -> DataFrame:
    """The ranked chunks and, one hop away, those before and after them in the same set and section.

    `same` is a column of the chunks (null being a section too). Adds `hop`: 0 for a chunk that was found, -1 and 1 for its
    neighbours. A chunk that is found or reached several times comes once, with its best rank, and as found if it was.
    """
    there = chunks.select(*CHUNK, "previous_chunk_id", "next_chunk_id", F.col(same).alias("section"))
    at = found.join(there, CHUNK)
    to = [F.struct(F.lit(hop).alias("hop"), F.col(c).alias("id")) for hop, c in ((0, "chunk_id"), (-1, "previous_chunk_id"), (1, "next_chunk_id"))]
    hops = at.select("query_id", "rank", "score", "chunk_set_id", "section", F.explode(F.array(*to)).alias("to"))
    hops = hops.filter(F.col("to.id").isNotNull()).select("query_id", "rank", "score", "chunk_set_id", F.col("to.id").alias("chunk_id"), F.col("to.hop").alias("hop"), "section")
    near = chunks.select(*CHUNK, F.col(same).alias("own"))
    kept = hops.join(near, CHUNK).filter((F.col("hop") == 0) | F.col("section").eqNullSafe(F.col("own")))
    best = F.min(F.struct(F.abs("hop").alias("far"), "rank", "hop", F.col("score"))).alias("best")
    return kept.groupBy("query_id", *CHUNK).agg(best).select("query_id", "best.rank", *CHUNK, "best.score", "best.hop")


def within_budget(found: DataFrame, chunks: DataFrame, budget: int) -> DataFrame:
    """The rows whose running number of tokens stays within the budget, in order of rank, chunks as found before neighbours, then sequence.

    A row that doesn't fit ends a query's context: nothing smaller behind it slips in, so a larger budget only adds rows. Adds
    `place` from 1, `tokens` so far, and the content.
    """
    rows = found.join(chunks.select(*CHUNK, "sequence", "token_count", "content"), CHUNK)
    order = Window.partitionBy("query_id").orderBy("rank", F.abs("hop"), "chunk_set_id", "sequence", "chunk_id")
    running = F.sum("token_count").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("place", F.row_number().over(order)).withColumn("tokens", running).filter(F.col("tokens") <= budget).select("query_id", "place", *CHUNK, "rank", "hop", "score", "token_count", "tokens", "content")

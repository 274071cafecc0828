"""Keyword search: postings counted in each chunk's row, statistics by grouped aggregation, BM25 as a join of the queries' terms with the postings.

Visibility and scope are as for vectors: postings of sets that aren't active and of hidden chunks neither count nor are found.
Shares of a score are whole numbers (billionths), so sums don't depend on the order in which Spark adds, and chunks of equal
texts tie exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import in_batches

#: BM25's saturation of repeated terms and weight of a chunk's length; units of a score.
K1, B, UNITS = 1.2, 0.75, 1_000_000_000
SCOPE = ["tenant_id", "knowledge_base_id"]
CHUNK = ["chunk_set_id", "chunk_id"]
#: Rows of query terms that may be broadcast to the postings.
BROADCAST_TERMS = 100_000


def terms(text: Column) -> Column:
    """The runs of letters and digits of a text, in lower case and in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(chunks: DataFrame) -> DataFrame:
    """chunk_set_id, chunk_id, term, tf (how often) and length (all terms of the chunk): what to store beside the chunks.

    A chunk (one row) is counted in its own row: nothing is shuffled, and a task holds a batch of chunks. Chunks without terms have no postings.
    """
    return exploded(counted(chunks), *CHUNK).select(*CHUNK, "term", "tf", "length")


def counted(chunks: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """A row for each chunk: chunk_set_id, chunk_id, length (all its terms), found: term and tf of each of its terms, or of those wanted."""
    rows = chunks.select(*CHUNK, terms(F.col("content")).alias("terms"))
    asked = None if wanted is None else chunks.sparkSession.sparkContext.broadcast(pa.array(wanted, pa.string()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["terms"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            words = b["terms"].flatten()
            known = words.unique() if asked is None else asked.value
            at = pc.fill_null(pc.index_in(words, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            most = max(1, len(known))
            key, tf = np.unique((np.repeat(np.arange(len(b)), sizes) * most + at)[at >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(key // most, np.arange(len(b) + 1)), pa.int32())
            pairs = pa.StructArray.from_arrays([known.take(pa.array(key % most)), pa.array(tf, pa.int64())], ["term", "tf"])
            yield pa.RecordBatch.from_arrays([b["chunk_set_id"], b["chunk_id"], pa.array(sizes), pa.ListArray.from_arrays(ends, pairs)], ["chunk_set_id", "chunk_id", "length", "found"])

    return in_batches(rows, work, "chunk_set_id string, chunk_id string, length long, found array<struct<term: string, tf: long>>")


def exploded(rows: DataFrame, *kept: str) -> DataFrame:
    """Rows of `counted` as postings, with the columns `kept`."""
    return rows.select(*kept, "length", F.explode("found").alias("f")).select(*kept, "f.term", "f.tf", "length")


def visible(postings: DataFrame, sets: DataFrame, hidden: DataFrame | None = None) -> DataFrame:
    """Postings of active sets with their scope, without those of hidden chunks."""
    active = sets.filter("status = 'active'").select(F.col("id").alias("chunk_set_id"), *SCOPE)
    seen = postings.join(active, "chunk_set_id")
    return seen if hidden is None else seen.join(hidden.select(*CHUNK), CHUNK, "left_anti")


def statistics(seen: DataFrame) -> DataFrame:
    """tenant_id, knowledge_base_id, chunks and their mean length, of each scope."""
    return means(seen.groupBy(*SCOPE, *CHUNK).agg(F.first("length").alias("length")))


def means(chunks: DataFrame) -> DataFrame:
    """The same from a row for each chunk: those without terms don't count."""
    return chunks.filter("length > 0").groupBy(*SCOPE).agg(F.count("*").alias("chunks"), (F.sum("length") / F.count("*")).alias("mean"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, tenant_id, knowledge_base_id, term: each term of a query once."""
    return queries.select("query_id", *SCOPE, F.explode(F.array_distinct(terms(F.col("query")))).alias("term"))


def wanted_terms(queries: DataFrame) -> list[str] | None:
    """The distinct terms of a stated set of queries, or None where they are too many to send to every task."""
    found = query_terms(queries).select("term").distinct().limit(BROADCAST_TERMS + 1).toArrow()["term"].to_pylist()
    return found if len(found) <= BROADCAST_TERMS else None


def scored(queries: DataFrame, seen: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """query_id, chunk_set_id, chunk_id, score (whole billionths): BM25 of every visible chunk that has a term of the query in its scope.

    The queries are a stated set. Their terms meet the postings in the postings' own partitions while they are few, so a term
    that very many chunks have isn't gathered anywhere; document frequencies are counted for the queries' terms alone.
    of: the scopes' statistics, where `seen` has the queries' terms alone.
    """
    asked = query_terms(queries)
    wanted = asked.select(*SCOPE, "term").distinct()
    few = wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    put = F.broadcast if few else (lambda df: df)
    frequencies = seen.join(put(wanted), [*SCOPE, "term"]).groupBy(*SCOPE, "term").agg(F.count("*").alias("df"))
    weights = asked.join(frequencies, [*SCOPE, "term"]).join(statistics(seen) if of is None else of, SCOPE)
    weights = weights.withColumn("idf", F.log(1 + (F.col("chunks") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    pairs = seen.join(put(weights), [*SCOPE, "term"])
    share = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return pairs.groupBy("query_id", *CHUNK).agg(F.sum(F.round(share * UNITS).cast("long")).alias("score"))


def search_keyword(queries: DataFrame, seen: DataFrame, limit: int, of: DataFrame | None = None) -> DataFrame:
    """query_id, rank, chunk_set_id, chunk_id, score of the best chunks of each query (query_id, tenant_id, knowledge_base_id, query); ties by set and chunk."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *CHUNK)
    return scored(queries, seen, of).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit).select("query_id", "rank", *CHUNK, "score")

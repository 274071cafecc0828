"""Incremental builds: what to delete, to write and to embed again, as joins of what is stored with what is wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = ["chunk_set_id", "chunk_id"]


def missing_inputs(inputs: DataFrame, stored: DataFrame) -> DataFrame:
    """Inputs without a stored embedding of the same hash in the same model space."""
    have = stored.select(*CHUNK, "model_key", F.col("input_sha256").alias("stored_sha256"))
    return inputs.join(have, [*CHUNK, "model_key"], "left").filter(~F.col("input_sha256").eqNullSafe(F.col("stored_sha256"))).drop("stored_sha256")


def deleted_chunks(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    return stored.join(wanted.select(*CHUNK), CHUNK, "left_anti")


def stale_embeddings(stored: DataFrame, inputs: DataFrame) -> DataFrame:
    """Stored embeddings of another model space, or of chunks that aren't embedded any more."""
    return stored.join(inputs.select(*CHUNK, "model_key"), [*CHUNK, "model_key"], "left_anti")


def upserted(stored: DataFrame, new: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """New rows with the stored values of the columns `kept`, and stored rows that aren't replaced."""
    rest = [c for c in stored.columns if c not in keys]
    old = stored.select(*keys, F.struct(*rest).alias("stored"))
    met = new.select(*keys, F.struct(*rest).alias("new")).join(old, keys, "full")  # one pass over either side
    value = lambda c: F.coalesce(F.col("stored")[c], F.col("new")[c]) if c in kept else F.when(F.col("new").isNull(), F.col("stored")[c]).otherwise(F.col("new")[c])
    return met.select(*keys, *(value(c).alias(c) for c in rest))


def inserted(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows, and new ones whose keys aren't stored: what is there already stays as it is."""
    return stored.unionByName(new.select(stored.columns).join(stored.select(*keys), keys, "left_anti"))


def hidden(embeddings: DataFrame, sets: DataFrame) -> DataFrame:
    """Embeddings, those of the sets (id) not visible: what a build that begins again does to its own."""
    chosen = sets.select(F.col("id").alias("chunk_set_id")).distinct().withColumn("again", F.lit(True))
    return embeddings.join(chosen, "chunk_set_id", "left").withColumn("searchable", F.col("searchable") & F.col("again").isNull()).select(embeddings.columns)


def cascaded(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """Chunks or embeddings that are left once sets (id) are deleted."""
    return rows.join(deleted.select(F.col("id").alias("chunk_set_id")), "chunk_set_id", "left_anti")


def index_result(chunks: DataFrame, inputs: DataFrame, pending: DataFrame) -> DataFrame:
    """Counts of a build: chunks, inputs, generated (pending) and reused ones."""
    counts = [x.groupBy("chunk_set_id").agg(F.count("*").alias(n)) for x, n in ((chunks, "chunk_count"), (inputs, "embedding_count"), (pending, "generated_embedding_count"))]
    out = counts[0].join(counts[1], "chunk_set_id", "left").join(counts[2], "chunk_set_id", "left").na.fill(0)
    return out.withColumn("reused_embedding_count", F.col("embedding_count") - F.col("generated_embedding_count"))


def published(sets: DataFrame, target: DataFrame) -> DataFrame:
    """Statuses after publishing the sets in `target` (id): the active ones of their scopes retire, they become active."""
    scope = ["tenant_id", "knowledge_base_id", "document_id", "strategy_name"]
    scopes = sets.join(target, "id", "left_semi").select(*scope).distinct().withColumn("switched", F.lit(True))
    marked = sets.join(target.select("id").withColumn("chosen", F.lit(True)), "id", "left").join(scopes, scope, "left")
    status = F.when(F.col("chosen"), F.lit("active")).when(F.col("switched") & (F.col("status") == "active"), F.lit("retired")).otherwise(F.col("status"))
    return marked.withColumn("status", status).select(sets.columns)

"""The three tables as Spark's own: partitioned by scope, bucketed and sorted by set.

A search reads the folders of its scope alone. Rows of one set lie in one bucket of every table, so joins by set and scans in
a set's order need no exchange, however many sets there are; sets have no folders or files of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import search
from ..operators.search import SearchRequest
from ..sources import schemas
from ..sources.schemas import qualified

SCOPE = ["tenant_id", "knowledge_base_id"]
#: Spark's setting without which a join by set and chunk isn't satisfied by buckets of sets.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Layout:
    """Where the tables are: a schema (database) of the catalog, a folder of any store for their files, and the number of buckets.

    The number of buckets is a table's for good: it is chosen so that a bucket of the largest scope fits a task, and a scope
    has at most as many files as buckets.
    """

    spark: SparkSession
    schema: str
    folder: str
    buckets: int = 64

    def _name(self, table: str) -> str:
        return qualified(self.schema, table)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows in the partitions of their buckets: what is joined to them by set there needs no exchange, nor does the writer."""
        return df.repartition(self.buckets, "chunk_set_id")

    def _save(self, name: str, rows: DataFrame, order: list[str]) -> None:
        """Writes dealt rows; the writer sorts them by scope, bucket and order."""
        writer = rows.write.partitionBy(*SCOPE).bucketBy(self.buckets, "chunk_set_id").sortBy("chunk_set_id", *order)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(self._name(name), format="parquet")

    def _scoped(self, df: DataFrame) -> DataFrame:
        """Dealt rows with the scope of their set, from the buckets of the saved sets: rows are moved once."""
        return self._dealt(df.drop(*SCOPE)).join(self.table("chunk_sets").select("chunk_set_id", *SCOPE), "chunk_set_id")

    def save(self, sets: DataFrame, chunks: DataFrame, embeddings: DataFrame) -> None:
        """Writes the tables: sets (with `id` as chunk_set_id), chunks and embeddings with the scope of their set.

        Rows without a set, or of a set without a scope, break the store's rules and aren't written.
        """
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema}`")
        self._save("chunk_sets", self._dealt(sets.withColumnRenamed("id", "chunk_set_id")), [])
        self._save("chunks", self._scoped(chunks), ["sequence", "chunk_id"])
        self._save("chunk_embeddings", self._scoped(embeddings), ["chunk_id"])

    def drop(self) -> None:
        for name in ("chunk_sets", "chunks", "chunk_embeddings"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")

    def drift(self) -> list[schemas.Drift]:
        """Where the tables differ from their schemas: missing or other columns, and nulls where there may be none."""
        named = {name: self.table(name) for name in schemas.TABLES}
        named["chunk_sets"] = named["chunk_sets"].withColumnRenamed("chunk_set_id", "id")
        return schemas.drift({n: df.schema for n, df in named.items()}, nullability=False) or [d for n, df in named.items() for d in schemas.nulls(n, df)]

    def ordered(self) -> DataFrame:
        """The chunks with `place` in their set, from 1, and the id of the one before: a scan in each bucket's own task."""
        order = Window.partitionBy("chunk_set_id").orderBy("sequence", "chunk_id")
        return self.table("chunks").withColumns({"place": F.row_number().over(order), "before": F.lag("chunk_id").over(order)})

    def with_vectors(self) -> DataFrame:
        """Chunks with their vectors: buckets meet, nothing is exchanged."""
        self.spark.conf.set(ALL_KEYS, "false")
        return self.table("chunks").join(self.table("chunk_embeddings").drop(*SCOPE), ["chunk_set_id", "chunk_id"])

    def visible(self) -> DataFrame:
        """Searchable vectors of active sets. The scope is part of the join, so scopes without such sets aren't read."""
        active = self.table("chunk_sets").filter("status = 'active'").select("chunk_set_id", *SCOPE, "document_id", "source_uri", "source_name")
        return self.table("chunk_embeddings").filter("searchable").join(active, ["chunk_set_id", *SCOPE])

    def search(self, request: SearchRequest) -> DataFrame:
        """The exact search over the folders of the request's scope."""
        of_scope = lambda df: df.filter((F.col("tenant_id") == request.tenant_id) & (F.col("knowledge_base_id") == request.knowledge_base_id))
        sets = of_scope(self.table("chunk_sets")).withColumnRenamed("chunk_set_id", "id")
        return search.search(sets, of_scope(self.table("chunks")), of_scope(self.table("chunk_embeddings")).drop(*SCOPE), request)

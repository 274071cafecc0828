"""The two workflows: indexing a document as a new version, and retrieving evidence for a query."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidBuild, InvalidRequest
from ..functions import exprs as X
from ..operators import search
from ..operators.chunking import PARENT_CHILD, STRUCTURE_AWARE, AutomaticChunker
from ..operators.embedder import Embedder, checked, embed_inputs
from ..operators.mapping import BuildData, BuildSpec, ModelProfile, map_build
from ..operators.reconcile import index_result
from ..sources import units as U
from .runtime import Descriptor, Observer, Runner, require
from .store import IndexStore

INDEXING, RETRIEVAL = Descriptor("rag_document_indexing", "v5"), Descriptor("rag_vector_retrieval", "v1")


@dataclass(frozen=True)
class IndexRequest:
    run_id: str
    source_uri: str
    set_id: str
    tenant_id: str
    knowledge_base_id: str
    document_id: str
    canonical_uri: str
    source_name: str
    title: str = ""

    def __post_init__(self) -> None:
        if any(not getattr(self, n).strip() for n in ("run_id", "source_uri", "set_id", "tenant_id", "knowledge_base_id", "document_id", "canonical_uri", "source_name")):
            raise InvalidRequest("the request lacks a field of its target")


@dataclass(frozen=True)
class IndexState:
    request: IndexRequest
    units: DataFrame | None = None
    strategy: str = ""
    chunks: DataFrame | None = None
    spec: BuildSpec | None = None
    build: BuildData | None = None
    pending: DataFrame | None = None
    records: DataFrame | None = None
    counts: dict = field(default_factory=dict)


class IndexingWorkflow:
    """ingest -> chunk -> prepare -> embed -> persist -> validate -> publish. A failed run leaves the set being built; a run
    of the same set goes on from there and embeds only what has no vector of its hash."""

    def __init__(self, spark: SparkSession, store: IndexStore, embedder: Embedder, chunker: AutomaticChunker = AutomaticChunker(), model: ModelProfile = ModelProfile(), observers: Sequence[Observer] = ()):
        require(store=store, embedder=embedder, chunker=chunker, model=model)
        self.spark, self.store, self.embedder, self.chunker, self.model = spark, store, embedder, chunker, model
        names = ("ingest_document", "chunk_document", "prepare_index", "embed_chunks", "persist_index", "validate_index", "publish_index")
        self.runner = Runner(spark, INDEXING, [(n, getattr(self, n)) for n in names], observers)

    def run(self, request: IndexRequest) -> dict:
        return self.runner.run(request.run_id, IndexState(request)).counts

    def ingest_document(self, s: IndexState) -> IndexState:
        found = U.read_source(self.spark, s.request.source_uri).withColumn("document_id", F.lit(s.request.document_id))
        units = U.stamped(U.prepared(found), F.lit(s.request.canonical_uri), F.col("mime_type")).cache()
        kinds = units.select("structured", "content_sha256").distinct().limit(2).collect()
        if not kinds:
            raise InvalidBuild("the document has no content")
        if len(kinds) > 1:
            raise InvalidBuild("the address names more than one document")
        return replace(s, units=units, strategy=STRUCTURE_AWARE if kinds[0]["structured"] else PARENT_CHILD, counts={"content_sha256": kinds[0]["content_sha256"]})

    def chunk_document(self, s: IndexState) -> IndexState:
        return replace(s, chunks=self.chunker.chunk(s.units).drop("strategy_name"))

    def prepare_index(self, s: IndexState) -> IndexState:
        r = s.request
        spec = BuildSpec(r.set_id, r.tenant_id, r.knowledge_base_id, r.document_id, r.canonical_uri, r.source_name, s.counts["content_sha256"], s.strategy, self.chunker.config, self.model, r.title)
        build = map_build(spec, s.chunks, (self.chunker.config.profile_name, self.chunker.config.profile_version))
        pending = self.store.prepare_build(build, spec).cache()
        row = index_result(build.chunks, build.inputs, pending).first().asDict()
        return replace(s, spec=spec, build=build, pending=pending, counts=s.counts | row)

    def embed_chunks(self, s: IndexState) -> IndexState:
        return s if s.pending.isEmpty() else replace(s, records=embed_inputs(s.pending, self.embedder, self.model.dimensions).cache())

    def persist_index(self, s: IndexState) -> IndexState:
        if s.records is not None:
            self.store.save_embeddings(s.request.set_id, s.records)
        return s

    def validate_index(self, s: IndexState) -> IndexState:
        return replace(s, counts=s.counts | {"vectors": self.store.validate(s.request.set_id), "validation_passed": True})

    def publish_index(self, s: IndexState) -> IndexState:
        self.store.publish(s.request.set_id)
        for df in (s.units, s.pending, s.records):
            if df is not None:
                df.unpersist()
        return replace(s, counts=s.counts | {"published": True, "workflow": str(INDEXING), "set_id": s.request.set_id})


@dataclass(frozen=True)
class Query:
    run_id: str
    query: str
    tenant_id: str
    knowledge_base_id: str
    top_k: int = 3

    def normalised(self) -> Query:
        q = replace(self, run_id=self.run_id.strip(), query=self.query.strip(), tenant_id=self.tenant_id.strip(), knowledge_base_id=self.knowledge_base_id.strip())
        if not all((q.run_id, q.query, q.tenant_id, q.knowledge_base_id)) or len(q.query) > search.QUERY_RUNES or not 1 <= q.top_k <= search.MOST:
            raise InvalidRequest("the query lacks a field or is out of bounds")
        try:
            "".join((q.run_id, q.query, q.tenant_id, q.knowledge_base_id)).encode()
        except UnicodeEncodeError:
            raise InvalidRequest("the query isn't valid Unicode") from None
        return q


class RetrievalWorkflow:
    def __init__(self, spark: SparkSession, store: IndexStore, embedder: Embedder, model: ModelProfile = ModelProfile(), observers: Sequence[Observer] = ()):
        require(store=store, embedder=embedder, model=model)
        self.spark, self.store, self.embedder, self.model = spark, store, embedder, model
        self.key = spark.range(1).select(model.key()).first()[0]
        self.runner = Runner(spark, RETRIEVAL, [("embed_query", self.embed_query), ("retrieve_evidence", self.retrieve_evidence), ("build_result", self.build_result)], observers)

    def run(self, query: Query) -> dict:
        query = query.normalised()
        return self.runner.run(query.run_id, {"query": query})

    def embed_query(self, s: dict) -> dict:
        [(vector, tokens)] = checked(self.embedder.embed([s["query"].query]), 1, self.model.dimensions)
        return s | {"vector": vector, "tokens": tokens}

    def retrieve_evidence(self, s: dict) -> dict:
        q = s["query"]
        request = search.SearchRequest(q.tenant_id, q.knowledge_base_id, self.key, s["vector"], q.top_k, self.model.dimensions)
        rows = [r.asDict() for r in self.store.search(request).collect()]  # at most twenty
        search.validate_evidence(rows, q.top_k)
        return s | {"evidence": rows}

    def build_result(self, s: dict) -> dict:
        return {"workflow": str(RETRIEVAL), "run_id": s["query"].run_id, "status": "completed", "model_key": self.key, "query_tokens": s["tokens"], "evidence": s["evidence"]}

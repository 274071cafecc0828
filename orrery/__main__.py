"""python -m orrery index URI [set id] | search [query] [k]: with settings from the environment.

EMBEDDING_BASE_URL and EMBEDDING_KEY name an embedding service; without either a local embedder stands in, under a model name
of its own, so that its vectors are never taken for a service's.
"""

from __future__ import annotations

import json
import os
import sys
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .errors import InvalidConfig, InvalidRequest
from .functions import exprs as X
from .operators.embedder import Embedder, HashEmbedder, HttpEmbedder
from .operators.mapping import ModelProfile
from .plans import config
from .plans.store import IndexStore
from .plans.workflows import IndexingWorkflow, IndexRequest, Query, RetrievalWorkflow

TENANT, KNOWLEDGE_BASE, LOCAL_MODEL = "local", "default", "local-hashed-words"


def arguments(args: list[str]) -> tuple[str, int]:
    """A query and how many rows it gets: at most two arguments, the second from 1 to 20."""
    if len(args) > 2:
        raise InvalidRequest("at most a query and a number")
    query = args[0].strip() if args else "strategy"
    k = args[1] if len(args) > 1 else "3"
    if not query or not k.isdecimal() or not 1 <= int(k) <= 20:
        raise InvalidRequest("a query, and a number from 1 to 20")
    return query, int(k)


def embedding(settings: config.Settings) -> tuple[ModelProfile, Embedder]:
    """The model space and what embeds into it: the service that the settings name, or the local embedder."""
    if settings.embedding_base_url and settings.embedding_key:
        client = HttpEmbedder(settings.embedding_base_url, settings.embedding_key, settings.embedding_model, settings.dimensions, settings.timeout_s, settings.batch)
        return ModelProfile(settings.embedding_model, settings.dimensions), client
    if settings.embedding_base_url or settings.embedding_key:
        raise InvalidConfig("EMBEDDING_BASE_URL and EMBEDDING_KEY go together")
    return ModelProfile(LOCAL_MODEL, settings.dimensions), HashEmbedder(settings.dimensions)


def main(argv: list[str]) -> int:
    settings = config.load(os.environ)
    model, embedder = embedding(settings)
    spark = SparkSession.builder.appName("orrery").getOrCreate()
    try:
        return run(spark, settings, model, embedder, argv)
    finally:
        spark.stop()


def run(spark: SparkSession, settings: config.Settings, model: ModelProfile, embedder: Embedder, argv: list[str]) -> int:
    store = IndexStore(spark, settings.root, settings.dimensions)
    if argv[:1] == ["index"] and 2 <= len(argv) <= 3:
        uri = F.lit(argv[1])
        name, document, title = spark.range(1).select(X.display_name(uri), X.document_id(uri), X.title(X.display_name(uri))).first()
        request = IndexRequest(uuid.uuid4().hex, argv[1], argv[2] if len(argv) > 2 else str(uuid.uuid4()), TENANT, KNOWLEDGE_BASE, document, f"knowledge://local/{document}", name, title)
        result = IndexingWorkflow(spark, store, embedder, model=model).run(request)
    elif argv[:1] == ["search"]:
        query, k = arguments(argv[1:])
        result = RetrievalWorkflow(spark, store, embedder, model).run(Query(uuid.uuid4().hex, query, TENANT, KNOWLEDGE_BASE, k))
    else:
        print(__doc__, file=sys.stderr)
        return 2
    print(json.dumps(result, indent=2, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""A build from a chunking result: the set's row, its chunks and the inputs to be embedded."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidBuild
from ..functions import canonical as J
from ..functions import exprs as X
from .chunking import PARENT_CHILD, STRUCTURE_AWARE, ChunkConfig


@dataclass(frozen=True)
class ModelProfile:
    model: str = "text-embedding-v4"
    dimensions: int = 1536
    distance: str = "cosine"
    version: str = "v1"

    def __post_init__(self) -> None:
        if not self.model.strip() or not self.version.strip() or self.distance.strip() != "cosine" or self.dimensions < 1:
            raise InvalidBuild("the model profile is incomplete")

    def key(self) -> Column:
        return X.model_key(F.lit(self.model), F.lit(self.dimensions), F.lit(self.distance), F.lit(self.version))


@dataclass(frozen=True)
class BuildSpec:
    """What identifies one build: the set, its scope, the document and how it is chunked and embedded."""

    set_id: str
    tenant_id: str
    knowledge_base_id: str
    document_id: str
    source_uri: str
    source_name: str
    content_sha256: str
    strategy_name: str
    config: ChunkConfig = ChunkConfig()
    model: ModelProfile = ModelProfile()
    title: str = ""

    def snapshot(self) -> str:
        c = self.config
        if self.strategy_name == PARENT_CHILD:
            found = {"parent_max_runes": c.parent_max, "child_max_runes": c.child_max}
        elif self.strategy_name == STRUCTURE_AWARE:
            found = {"max_runes": c.structure_max, "min_runes": c.structure_min, "heading_context": c.heading_context.strip()}
        else:
            raise InvalidBuild(f"unknown strategy {self.strategy_name}")
        return json.dumps(found | {"embedding_input_policy": "v1"}, separators=(",", ":"))


@dataclass(frozen=True)
class BuildData:
    """Lazy frames: sets (one row), chunks, inputs."""

    sets: DataFrame
    chunks: DataFrame
    inputs: DataFrame


def embeddable(strategy: str) -> Column:
    return F.col("kind") == ("child" if strategy == PARENT_CHILD else "structure")


def semantic_path(metadata: Column) -> Column:
    """The heading path in a chunk's metadata; null unless it is an array of strings."""
    path = F.get_json_object(metadata, "$.semantic_path")
    texts = F.schema_of_variant(F.try_parse_json(path)) == "ARRAY<STRING>"
    return F.when(texts, F.from_json(path, "array<string>"))


def map_build(spec: BuildSpec, chunks: DataFrame, profile: tuple[str, str] | None = None) -> BuildData:
    """The rows of a build, in the same order and with the same hashes each time; `validate` says whether they are right.

    profile: name and version under which the chunks were made; another one than the spec's is refused.
    """
    if profile is not None and tuple(x.strip() for x in profile) != (spec.config.profile_name.strip(), spec.config.profile_version.strip()):
        raise InvalidBuild("R-PROF: the chunks were made under another profile")
    spark = chunks.sparkSession
    row = [x.strip() for x in (spec.set_id, spec.tenant_id, spec.knowledge_base_id, spec.document_id, spec.source_uri, spec.source_name, spec.content_sha256, spec.strategy_name, spec.config.profile_name, spec.config.profile_version)]
    names = "id tenant_id knowledge_base_id document_id source_uri source_name content_sha256 strategy_name profile_name profile_version config status".split()
    sets = spark.createDataFrame([(*row, spec.snapshot(), "building")], ", ".join(f"{n} string" for n in names))
    optional = {c: F.nullif(F.col(c), F.lit("")) for c in ("parent_chunk_id", "previous_chunk_id", "next_chunk_id")}
    rows = chunks.select(F.lit(spec.set_id).alias("chunk_set_id"), "document_id", "chunk_id", "kind", "level", *(v.alias(k) for k, v in optional.items()), "sequence", "content", "character_count", "token_count", "source_unit_ids", J.without_set_keys(F.col("metadata")).alias("metadata"))
    if spec.strategy_name == PARENT_CHILD:
        text = X.embedding_text_parent_child(F.lit(spec.title), F.col("content"))
    else:
        text = X.embedding_text_structure(F.lit(spec.config.heading_context), semantic_path(F.col("metadata")), F.col("content"), F.get_json_object("metadata", "$.headings_apart") == "true")
    inputs = rows.filter(embeddable(spec.strategy_name)).select("chunk_set_id", "chunk_id", spec.model.key().alias("model_key"), text.alias("embedding_text"))
    return BuildData(sets, rows, inputs.withColumn("input_sha256", X.sha256("embedding_text")))

"""The engine's queries over the given tables, and SQL that gives the same rows.

`embeddings` stand for chunks with vectors: each row is a set of one chunk, whose scope, status, visibility and model space
follow from its number, so that every filter has rows that only it excludes. `documents` are chunked in windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import exprs as X
from .operators import chunking, reconcile, rules, search
from .operators.chunking import PARENT_CHILD, ChunkConfig
from .operators.mapping import ModelProfile
from .sources import units as U
from .sources.shared import in_batches

CONFIG = ChunkConfig()
QUERY_ID, TENANT, KNOWLEDGE_BASE, TOP = 17, "tenant-2", "kb-1", 20
MODEL = ModelProfile(dimensions=64)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), (F.col(c) if isinstance(c, str) else c).cast("string"))


def uuid_of(c: Column) -> Column:
    h = F.md5(c)
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


# ---- embeddings as an index


def vector_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e, v = read(spark, sf_dir, "embeddings"), F.col("vec_id")
    document = X.document_id(U.synthetic_uri(v))
    set_id = uuid_of(text_of("set:", v))
    status = F.when(v % 10 == 0, "building").when(v % 10 == 1, "retired").otherwise("active")
    sets = e.select(set_id.alias("id"), text_of("tenant-", v % 3).alias("tenant_id"), text_of("kb-", v % 2).alias("knowledge_base_id"), document.alias("document_id"), F.concat(F.lit("knowledge://local/"), document).alias("source_uri"), text_of("document ", v).alias("source_name"), F.lit(PARENT_CHILD).alias("strategy_name"), status.alias("status"))
    chunks = e.select(set_id.alias("chunk_set_id"), text_of("chunk-", v).alias("chunk_id"), F.lit("child").alias("kind"), F.lit(1).alias("sequence"), text_of("content of ", v).alias("content"), F.lit(3).alias("token_count"), F.array(text_of("unit-", v)).alias("source_unit_ids"), F.lit("{}").alias("metadata"))
    key = F.when(v % 13 == 0, F.lit("other")).otherwise(MODEL.key())
    vectors = e.select(set_id.alias("chunk_set_id"), text_of("chunk-", v).alias("chunk_id"), key.alias("model_key"), "embedding", (v % 11 != 0).alias("searchable"))
    return sets, chunks, vectors


VECTORS = f"""WITH e AS (SELECT vec_id AS v, embedding, md5('set:' || vec_id) AS h, 'document-' || substr(sha256('synthetic://documents/' || vec_id), 1, 32) AS document_id FROM embeddings),
k AS (SELECT 'text-embedding-v4:' || sha256('text-embedding-v4' || chr(0) || '64' || chr(0) || 'cosine' || chr(0) || 'v1') AS key),
i AS (SELECT v, substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21,12) AS chunk_set_id, 'chunk-' || v AS chunk_id,
  'tenant-' || (v % 3) AS tenant_id, 'kb-' || (v % 2) AS knowledge_base_id, document_id, 'knowledge://local/' || document_id AS source_uri, 'document ' || v AS source_name,
  CASE v % 10 WHEN 0 THEN 'building' WHEN 1 THEN 'retired' ELSE 'active' END AS status, CASE WHEN v % 13 = 0 THEN 'other' ELSE key END AS model_key, v % 11 <> 0 AS searchable, embedding FROM e, k),
q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = {QUERY_ID}),
vis AS (SELECT * FROM i WHERE status = 'active' AND searchable)
"""


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(read(spark, sf_dir, "embeddings").filter(F.col("vec_id") == QUERY_ID).select("embedding").first()[0])


def vector_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: Top-K in one scope and model space, as the twelve columns of evidence."""
    sets, chunks, vectors = vector_index(spark, sf_dir)
    key = spark.range(1).select(MODEL.key()).first()[0]
    request = search.SearchRequest(TENANT, KNOWLEDGE_BASE, key, query_vector(spark, sf_dir), TOP, 64)
    found = search.search(sets, chunks, vectors, request)
    return found.withColumn("cosine_distance", F.round("cosine_distance", 6)).withColumn("source_unit_ids", F.to_json("source_unit_ids"))


def search_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with the first filter that excludes it from the flagship's search."""
    sets, _, vectors = vector_index(spark, sf_dir)
    key = MODEL.key()
    excluded = F.when(F.col("tenant_id") != TENANT, "tenant").when(F.col("knowledge_base_id") != KNOWLEDGE_BASE, "knowledge base").when(F.col("status") != "active", F.col("status")).when(~F.col("searchable"), "not searchable").when(F.col("model_key") != key, "model").otherwise("visible")
    return vectors.join(sets.withColumnRenamed("id", "chunk_set_id"), "chunk_set_id").groupBy(excluded.alias("excluded_by")).agg(F.count("*").alias("candidates"))


def batch_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, _, vectors = vector_index(spark, sf_dir)
    queries = read(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), MODEL.key().alias("model_key"))
    found = search.search_many(queries, search.visible(sets, vectors), 5)
    return found.withColumns({"cosine_distance": F.round("cosine_distance", 6), "rank": F.col("rank").cast("long")})


def visible_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, _, vectors = vector_index(spark, sf_dir)
    return search.visible(sets, vectors).groupBy("tenant_id", "knowledge_base_id", "model_key").agg(F.count("*").alias("candidates"))


def evidence_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All visible candidates of a query, ranked, in which every seventh row stands three places too early."""
    sets, _, vectors = vector_index(spark, sf_dir)
    ranks = search.ranked_all(search.visible(sets, vectors).filter(F.col("model_key") == MODEL.key()), query_vector(spark, sf_dir))
    moved = ranks.withColumn("rank", (F.col("rank") * 10 - F.when(F.col("rank") % 7 == 0, 35).otherwise(0)).cast("long"))
    return rules.evidence_order(moved)


def insert_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of a third of the numbers are stored; all come again as building ones."""
    sets, _, _ = vector_index(spark, sf_dir)
    sets = sets.withColumn("n", F.regexp_extract("source_name", "([0-9]+)$", 1).cast("long")).select("id", "n", "status")
    return reconcile.inserted(sets.filter("n % 3 = 0"), sets.withColumn("status", F.lit("building")), ["id"]).select("id", "status")


def reset_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of building sets, hidden again."""
    sets, _, vectors = vector_index(spark, sf_dir)
    return reconcile.hidden(vectors, sets.filter("status = 'building'")).select("chunk_set_id", "chunk_id", "searchable")


def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks and vectors that are left once the retired sets are deleted."""
    sets, chunks, vectors = vector_index(spark, sf_dir)
    gone = sets.filter("status = 'retired'").select("id")
    left = [reconcile.cascaded(x, gone).select(F.lit(n).alias("kind"), "chunk_set_id", "chunk_id") for n, x in (("chunk", chunks), ("vector", vectors))]
    return left[0].union(left[1])


def upsert_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of even numbers are stored at time 1; those of every third number come at time 2 with new hashes, and keep the time of what they replace."""
    v = F.col("vec_id")
    rows = lambda time: read(spark, sf_dir, "embeddings").select("vec_id", text_of("set-", v).alias("chunk_set_id"), text_of("chunk-", v).alias("chunk_id"), F.lit("m").alias("model_key"), F.concat(F.lit(f"hash {time} "), v.cast("string")).alias("input_sha256"), F.lit(time).cast("long").alias("created_at"), F.lit(time).cast("long").alias("updated_at"))
    stored, new = rows(1).filter(v % 2 == 0).drop("vec_id"), rows(2).filter(v % 3 == 0).drop("vec_id")
    return reconcile.upserted(stored, new, ["chunk_set_id", "chunk_id", "model_key"], ["created_at"])


def publish_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses once all building sets are published, where sets of one tenant and knowledge base share ten documents."""
    sets, _, _ = vector_index(spark, sf_dir)
    sets = sets.withColumn("document_id", F.substring("document_id", 10, 1))
    first = sets.filter("status = 'building'").groupBy("tenant_id", "knowledge_base_id", "document_id").agg(F.min("id").alias("id"))
    out = reconcile.published(sets, first.select("id"))
    return out.select("id", "tenant_id", "knowledge_base_id", "document_id", "status")


def active_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, _, _ = vector_index(spark, sf_dir)
    return rules.active_scopes(sets.withColumn("document_id", F.substring("document_id", 10, 1)))


def profile_config_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    sets = read(spark, sf_dir, "embeddings").select(F.lit(PARENT_CHILD).alias("strategy_name"), text_of("profile-", v % 7).alias("profile_name"), text_of("v", v % 3).alias("profile_version"), X.config_parent_child(F.when(v % 42 == 5, 1000).otherwise(2000), F.lit(500)).alias("config"))
    return rules.profile_configs(sets)


def config_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id").cast("int")
    return read(spark, sf_dir, "embeddings").select("vec_id", X.config_parent_child(v + 2000, v + 500).alias("parent_child"), X.config_structure(v + 1800, v + 600, F.lit("prepend")).alias("structure_aware"))


def model_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return read(spark, sf_dir, "embeddings").select("vec_id", X.model_key(F.concat(F.lit("  model-"), (v % 5).cast("string"), F.lit(" ")), (v % 3 + 64), F.lit("cosine"), text_of("v", v)).alias("model_key"))


def rule_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with NaN, infinite or too large numbers, or of other dimensions."""
    _, _, vectors = vector_index(spark, sf_dir)
    n = F.substring("chunk_id", 7, 20).cast("long")
    broken = F.when(n % 17 == 0, F.array(F.lit(float("nan")), F.lit(1.0))).when(n % 19 == 0, F.transform("embedding", lambda x: x.cast("double") * 1e300)).when(n % 23 == 0, F.slice(F.col("embedding").cast("array<double>"), 1, 63)).otherwise(F.col("embedding").cast("array<double>"))
    return rules.vectors(vectors.withColumn("embedding", broken), 64)


def rule_early_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, _, vectors = vector_index(spark, sf_dir)
    return rules.early_visible(sets, vectors)


def rule_source_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of twelve forms, by number: eight of these break the policy."""
    v = F.col("vec_id")
    forms = ["https://example.com/a/", "knowledge://local/", "http://example.org:8080/", "https://user:pw@example.com/", "/var/data/", "C:\\data\\", "relative/", "file:///tmp/", "https:///", "https://example.com/?q=", "https://example.com/#", " s3://bucket/key "]
    uri = F.concat(F.get(F.array(*map(F.lit, forms)), (v % 12).cast("int")), F.when(v % 12 < 11, v.cast("string")).otherwise(""))
    return rules.source_uri_policy(read(spark, sf_dir, "embeddings").select(v.alias("id"), uri.alias("source_uri")))


def form_of(forms: list[str], c: Column) -> Column:
    """One of the texts, by number."""
    return F.get(F.array(*map(F.lit, forms)), (c % len(forms)).cast("int"))


#: Identifiers that a set may have, and two that it may not; hashes likewise.
IDENTIFIERS = ["a", "a b", " a", "a\u3000", "\t", "", "é"]
HASHES = ["0" * 64, "0123456789abcdef" * 4, "A" * 64, "0" * 63, "g" * 64, ""]
#: (strategy, configuration) of sets; from the third on they break the rule.
SNAPSHOTS = [
    ("parent_child", '{"parent_max_runes":2000,"child_max_runes":500,"embedding_input_policy":"v1"}'),
    ("structure_aware", '{"max_runes":1800,"min_runes":600,"heading_context":"metadata_only","embedding_input_policy":"v1"}'),
    ("parent_child", '{"parent_max_runes":2000,"child_max_runes":500,"embedding_input_policy":"v2"}'),
    ("parent_child", '{"parent_max_runes":2000,"child_max_runes":500,"embedding_input_policy":"v1","extra":1}'),
    ("parent_child", '{"parent_max_runes":"2000","child_max_runes":500,"embedding_input_policy":"v1"}'),
    ("parent_child", '{"parent_max_runes":2000,"embedding_input_policy":"v1"}'),
    ("parent_child", '{"parent_max_runes":2000,"child_max_runes":500,"max_runes":1,"embedding_input_policy":"v1"}'),
    ("structure_aware", '{"max_runes":600,"min_runes":1800,"heading_context":"prepend","embedding_input_policy":"v1"}'),
    ("structure_aware", '{"max_runes":1800,"min_runes":600,"heading_context":"other","embedding_input_policy":"v1"}'),
    ("other", '{"max_runes":1800,"min_runes":600,"heading_context":"prepend","embedding_input_policy":"v1"}'),
    ("parent_child", "[]"),
    ("parent_child", "{"),
    ("structure_aware", '{"max_runes":1800.5,"min_runes":600,"heading_context":"prepend","embedding_input_policy":"v1"}'),
]
#: Metadata whose heading path is right or missing, and, from the sixth on, wrong.
PATHS = ["{}", '{"semantic_path":[]}', '{"semantic_path":["a"," b "]}', '{"semantic_path":null}', '{"x":[1]}', '{"semantic_path":[" "]}', '{"semantic_path":"a"}', '{"semantic_path":[1,"a"]}', '{"semantic_path":["a",null]}', '{"semantic_path":{"a":"b"}}', '{"semantic_path":[null]}', '{"semantic_path":7}']
#: Objects, and, from the fourth on, what isn't one.
METADATA = ["{}", '{"a":{"b":[1]}}', ' {"a":1} ', "[]", "null", '{"a":1}x', '{"a":NaN}', "", "7", '"x"']


def numbered_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets that break no rule: one for each vector."""
    v = F.col("vec_id")
    name = lambda n: text_of(f"{n}-", v).alias(n)
    return read(spark, sf_dir, "embeddings").select("vec_id", text_of("set-", v).alias("id"), *map(name, ("tenant_id", "knowledge_base_id", "document_id", "source_name", "profile_name", "profile_version")), F.lit(PARENT_CHILD).alias("strategy_name"))


def rule_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field of a set's scope and profile is blank or padded in some sets."""
    v, fields = F.col("vec_id"), ("tenant_id", "knowledge_base_id", "document_id", "source_name", "strategy_name", "profile_name", "profile_version")
    sets = numbered_sets(spark, sf_dir)
    return rules.blank_or_padded_scope(sets.withColumns({c: F.when(v % 8 == i, form_of(IDENTIFIERS, F.floor(v / 8))).otherwise(F.col(c)) for i, c in enumerate(fields)}))


def rule_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.content_hash_format(numbered_sets(spark, sf_dir).withColumn("content_sha256", form_of(HASHES, F.col("vec_id"))))


def rule_config_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return rules.config_snapshots(numbered_sets(spark, sf_dir).withColumns({"strategy_name": form_of([x for x, _ in SNAPSHOTS], v), "config": form_of([x for _, x in SNAPSHOTS], v)}))


def rule_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of which some were made under another profile, version or strategy."""
    sets, v = numbered_sets(spark, sf_dir), F.col("vec_id")
    other = {c: F.when(v % 10 == i, F.lit("other")).otherwise(F.col(c)) for i, c in enumerate(("strategy_name", "profile_name", "profile_version"))}
    return rules.profile_mismatches(sets.withColumns(other), sets)


def numbered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_sets(spark, sf_dir).select("vec_id", F.col("id").alias("chunk_set_id"), text_of("chunk-", "vec_id").alias("chunk_id"), "document_id")


def rule_other_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = numbered_chunks(spark, sf_dir).withColumn("document_id", F.when(F.col("vec_id") % 9 == 2, F.lit("document_id-x")).when(F.col("vec_id") % 9 != 3, F.col("document_id")))
    return rules.other_documents(chunks, numbered_sets(spark, sf_dir))


def rule_other_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.other_sets(numbered_chunks(spark, sf_dir), numbered_sets(spark, sf_dir).filter("vec_id % 4 <> 3"))


def rule_semantic_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading paths of all forms, in sets that take headings from the metadata and in sets that don't."""
    v = F.col("vec_id")
    sets = numbered_sets(spark, sf_dir).withColumn("config", X.config_structure(F.lit(1800), F.lit(600), F.when(v % 5 == 0, "prepend").otherwise("metadata_only")))
    return rules.semantic_paths(numbered_chunks(spark, sf_dir).withColumn("metadata", form_of(PATHS, v)), sets)


def rule_metadata_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.metadata_objects(numbered_chunks(spark, sf_dir).withColumn("metadata", form_of(METADATA, F.col("vec_id"))))


def rule_embedding_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some break one part of the rule each, and one in twenty is there twice."""
    e, v = read(spark, sf_dir, "embeddings"), F.col("vec_id")
    at = lambda n, wrong, right: F.when(v % 20 == n, wrong).otherwise(right)
    text = text_of("text of ", v)
    vector = at(7, F.slice("embedding", 1, 63), at(8, F.transform("embedding", lambda x: F.lit(float("nan")).cast("float")), F.col("embedding")))
    out = e.select(
        at(1, F.lit("no uuid"), uuid_of(text_of("set:", v))).alias("chunk_set_id"), at(2, F.lit(" padded"), text_of("chunk-", v)).alias("chunk_id"), at(3, F.lit(""), F.lit("m")).alias("model_key"), at(4, F.lit(" "), text).alias("embedding_text"),
        at(5, F.lit("0"), X.sha256(text)).alias("input_sha256"), at(6, F.lit(0), F.lit(3)).alias("embedding_token_count"), vector.alias("embedding"), "vec_id",
    )
    return rules.embedding_records(out.union(out.filter(v % 20 == 9)), 64)


# ---- documents as chunks


def of_one_row(docs: DataFrame) -> bool:
    """Whether every document is a row; else those of one id are numbered together. Ids alone are shuffled."""
    return docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


#: Documents that a task may have by itself, and how many times its even share it may have beyond them.
ALONE, SHARE = 4096, 2


def spread(docs: DataFrame) -> DataFrame:
    """Documents, dealt by id where few tasks would read most of them, as with a file of one row group. Rows are counted by task, no texts are read for it."""
    found = docs.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(4 * cores, "doc_id") if found.most and found.most > max(ALONE, SHARE * found.rows / cores) else docs


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return (U.prepared_rows if of_one_row(docs) else U.prepared)(U.of_table(docs))


def chunks_of(spark: SparkSession, sf_dir: str, sets: DataFrame | None = None) -> DataFrame:
    """Chunks of all documents, or of the few whose ids are among `sets` (chunk_set_id)."""
    docs = read(spark, sf_dir, "documents")
    prepare, cut = (U.prepared_rows, chunking.parent_child_rows) if of_one_row(docs) else (U.prepared, chunking.parent_child)
    given = U.of_table(docs if sets is not None else spread(docs))
    if sets is not None:
        given = given.join(F.broadcast(sets.select(F.col("chunk_set_id").alias("document_id")).distinct()), "document_id", "left_semi")
    return cut(prepare(given), CONFIG).withColumn("chunk_set_id", F.col("document_id"))


CHUNKS = """WITH d AS (SELECT 'document-' || substr(sha256('synthetic://documents/' || doc_id), 1, 32) AS document_id, source AS tenant_id, lang AS knowledge_base_id, sha256(text) AS content_sha256, text AS content FROM documents WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''),
u AS (SELECT *, 1 AS unit_index, sha256(content_sha256 || ':1:' || content) AS unit_id FROM d),
p AS (SELECT document_id, unit_id, unit_index, i AS parent_at, substr(content, i * 2000 + 1, 2000) AS content FROM u, unnest(range(CAST(ceil(length(content) / 2000.0) AS BIGINT))) AS t(i) WHERE regexp_replace(substr(content, i * 2000 + 1, 2000), '^\\s+|\\s+$', '', 'g') <> ''),
pp AS (SELECT *, sha256(document_id || ':parent:' || unit_index || ':' || parent_at || ':' || content) AS chunk_id FROM p),
w AS (SELECT document_id, unit_id, unit_index, parent_at, chunk_id AS parent_chunk_id, i AS idx, substr(content, i * 500 + 1, 500) AS content FROM pp, unnest(range(CAST(ceil(length(content) / 500.0) AS BIGINT))) AS t(i) WHERE regexp_replace(substr(content, i * 500 + 1, 500), '^\\s+|\\s+$', '', 'g') <> ''),
ww AS (SELECT *, sha256(parent_chunk_id || ':child:' || idx || ':' || content) AS chunk_id, row_number() OVER (PARTITION BY parent_chunk_id ORDER BY idx) - 1 AS child_at FROM w),
r AS (SELECT document_id, unit_id, unit_index, parent_at, -1 AS child_at, content, chunk_id, NULL AS parent_chunk_id, NULL AS previous_chunk_id, NULL AS next_chunk_id, 'parent' AS kind, 0 AS level FROM pp UNION ALL
  SELECT document_id, unit_id, unit_index, parent_at, child_at, content, chunk_id, parent_chunk_id, lag(chunk_id) OVER o, lead(chunk_id) OVER o, 'child', 1 FROM ww WINDOW o AS (PARTITION BY parent_chunk_id ORDER BY idx)),
c AS (SELECT *, document_id AS chunk_set_id, row_number() OVER (PARTITION BY document_id ORDER BY unit_index, parent_at, child_at) AS sequence, length(content) AS character_count, len(regexp_split_to_array(regexp_replace(content, '^\\s+|\\s+$', '', 'g'), '\\s+')) AS token_count FROM r),
n AS (SELECT document_id AS chunk_set_id, chunk_id, 'title' || chr(10) || chr(10) || content AS embedding_text FROM c WHERE kind = 'child'),
inp AS (SELECT *, sha256(embedding_text) AS input_sha256 FROM n)
"""


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def unit_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(units(spark, sf_dir).select("document_id", "tenant_id", "knowledge_base_id", "content_sha256", "unit_index", "unit_id"), "unit_index")


def unit_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six keys that each unit of the documents carries, beside one of its own; a key of the same name gives way."""
    own = U.of_table(read(spark, sf_dir, "documents")).withColumn("metadata", F.create_map(F.lit("language"), F.col("knowledge_base_id"), F.lit("unit_type"), F.lit("given")))
    found = U.stamped(U.prepared(own), F.col("uri"), F.lit("text/plain"))
    return found.select("unit_id", *(F.col("metadata")[k].alias(k) for k in ("language", "source_uri", "mime_type", "document_id", "document_version_id", "unit_type", "unit_index")))


def document_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.lit("https://example.com/files/part-"), (F.col("doc_id") % 50).cast("string"), F.lit(".tar/Report "), F.col("doc_id").cast("string"), F.lit(".md"))
    return read(spark, sf_dir, "documents").select("doc_id", X.document_id(uri).alias("document_id"), X.display_name(uri).alias("source_name"), X.title(X.display_name(uri)).alias("title"))


def parent_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks_of(spark, sf_dir).filter("kind = 'parent'").select("document_id", "chunk_id", "sequence", "level", "character_count", "token_count", "content")
    return longs(out, "sequence", "level", "character_count", "token_count")


def child_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks_of(spark, sf_dir).filter("kind = 'child'").select("document_id", "chunk_id", "parent_chunk_id", "sequence", "level", "character_count", "token_count", F.get("source_unit_ids", F.lit(0)).alias("unit_id"), "content")
    return longs(out, "sequence", "level", "character_count", "token_count")


def chunk_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks_of(spark, sf_dir).filter("kind = 'child'").select("chunk_id", "previous_chunk_id", "next_chunk_id")


def chunk_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(chunking.statistics(chunks_of(spark, sf_dir)), "chunks", "characters", "longest")


def inputs_of(chunks: DataFrame) -> DataFrame:
    text = X.embedding_text_parent_child(F.lit("title"), F.col("content"))
    found = chunks.filter("kind = 'child'").select("chunk_set_id", "chunk_id", F.lit("m").alias("model_key"), text.alias("embedding_text"))
    return found.withColumn("input_sha256", X.sha256("embedding_text"))


def embedding_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs_of(chunks_of(spark, sf_dir)).select("chunk_set_id", "chunk_id", "embedding_text", "input_sha256")


def embedding_inputs_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three heading modes, with paths of none to two headings."""
    n = F.col("doc_id") % 3
    path = F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(F.lit(" A "))).otherwise(F.array(F.lit("A"), text_of("B", "doc_id")))
    mode = F.when(F.col("doc_id") % 2 == 0, " prepend ").otherwise("metadata_only")
    return read(spark, sf_dir, "documents").select("doc_id", X.sha256(X.embedding_text_structure(mode, path, F.col("text"))).alias("input_sha256"))


def first(n: str) -> Column:
    return F.substring("chunk_id", 1, 2) == n


def twice(rows: DataFrame, n: str) -> DataFrame:
    """All rows, those whose id begins with `n` two times: in one pass over what they are made from."""
    times = F.when(first(n), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).drop("time")


def prepare_build_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs to embed where some are stored, some with another hash and some in another model space."""
    inputs = inputs_of(chunks_of(spark, sf_dir))
    stored = inputs.filter(F.substring("chunk_id", 1, 1) < "8").withColumns({"input_sha256": F.when(first("1a"), F.lit("changed")).otherwise(F.col("input_sha256")), "model_key": F.when(first("2b"), F.lit("other")).otherwise(F.col("model_key"))})
    return reconcile.missing_inputs(inputs, stored).select("chunk_set_id", "chunk_id", "input_sha256")


def index_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunks_of(spark, sf_dir)
    inputs = inputs_of(chunks)
    return reconcile.index_result(chunks, inputs, inputs.filter(F.substring("chunk_id", 1, 1) >= "8"))


def reconcile_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunks_of(spark, sf_dir)
    return reconcile.deleted_chunks(chunks.select("chunk_set_id", "chunk_id"), chunks.filter(F.substring("chunk_id", 1, 1) < "c"))


def reconcile_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored chunks (created 1) replaced by longer ones (created 2) for some, new ones added; `created` of stored ones stays."""
    chunks = chunks_of(spark, sf_dir).select("chunk_set_id", "chunk_id", F.col("character_count").cast("long").alias("characters"))
    stored = chunks.filter(F.substring("chunk_id", 1, 1) < "8").withColumn("created", F.lit(1).cast("long"))
    new = chunks.filter(F.substring("chunk_id", 1, 1) >= "4").select("chunk_set_id", "chunk_id", (F.col("characters") + 1).alias("characters"), F.lit(2).cast("long").alias("created"))
    return reconcile.upserted(stored, new, ["chunk_set_id", "chunk_id"], ["created"])


def stale_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = inputs_of(chunks_of(spark, sf_dir))
    stored = inputs.withColumn("model_key", F.when(first("2b"), F.lit("other")).otherwise(F.col("model_key")))
    return reconcile.stale_embeddings(stored, inputs.filter(F.substring("chunk_id", 1, 1) < "c")).select("chunk_set_id", "chunk_id", "model_key")


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of which some, by the first digits of their id, break one rule each."""
    c = chunks_of(spark, sf_dir)
    put = lambda n, c, v: F.when(first(n), v).otherwise(F.col(c))
    out = c.withColumns({
        "character_count": F.col("character_count") + F.when(first("0a"), 1).otherwise(0), "source_unit_ids": put("0b", "source_unit_ids", F.array(F.lit(" "))), "kind": put("0c", "kind", F.lit("other")),
        "parent_chunk_id": F.when(first("0d") & (F.col("kind") == "child"), F.lit("nowhere")).otherwise(F.col("parent_chunk_id")), "next_chunk_id": put("0e", "next_chunk_id", F.col("previous_chunk_id")), "sequence": put("0f", "sequence", F.lit(1)),
        "previous_chunk_id": put("1c", "previous_chunk_id", F.col("chunk_id")), "content": put("1d", "content", F.lit(" ")),
    })
    return twice(out, "1e")


BROKEN = CHUNKS + """, b0 AS (SELECT * REPLACE (
  CASE WHEN substr(chunk_id,1,2) = '0a' THEN character_count + 1 ELSE character_count END AS character_count,
  CASE WHEN substr(chunk_id,1,2) = '0b' THEN ' ' ELSE unit_id END AS unit_id,
  CASE WHEN substr(chunk_id,1,2) = '0c' THEN 'other' ELSE kind END AS kind,
  CASE WHEN substr(chunk_id,1,2) = '0d' AND kind = 'child' THEN 'nowhere' ELSE parent_chunk_id END AS parent_chunk_id,
  CASE WHEN substr(chunk_id,1,2) = '0e' THEN previous_chunk_id ELSE next_chunk_id END AS next_chunk_id,
  CASE WHEN substr(chunk_id,1,2) = '0f' THEN 1 ELSE sequence END AS sequence,
  CASE WHEN substr(chunk_id,1,2) = '1c' THEN chunk_id ELSE previous_chunk_id END AS previous_chunk_id,
  CASE WHEN substr(chunk_id,1,2) = '1d' THEN ' ' ELSE content END AS content) FROM c),
b AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE substr(chunk_id,1,2) = '1e')
"""


def broken_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = inputs_of(chunks_of(spark, sf_dir))
    out = i.filter(~first("2a")).withColumns({"input_sha256": F.when(first("2c"), X.sha256("chunk_id")).when(first("2d"), F.upper("input_sha256")).otherwise(F.col("input_sha256")), "model_key": F.when(first("2e"), F.lit("other")).otherwise(F.col("model_key")), "chunk_id": F.when(first("2f"), F.lit("nowhere")).otherwise(F.col("chunk_id"))})
    return twice(out, "3a")


BROKEN_INPUTS = CHUNKS + """, j0 AS (SELECT chunk_set_id, CASE WHEN substr(chunk_id,1,2) = '2f' THEN 'nowhere' ELSE chunk_id END AS chunk_id, CASE WHEN substr(chunk_id,1,2) = '2e' THEN 'other' ELSE 'm' END AS model_key, embedding_text,
  CASE substr(chunk_id,1,2) WHEN '2c' THEN sha256(chunk_id) WHEN '2d' THEN upper(input_sha256) ELSE input_sha256 END AS input_sha256 FROM inp WHERE substr(chunk_id,1,2) <> '2a'),
j AS (SELECT * FROM j0 UNION ALL SELECT * FROM j0 WHERE substr(chunk_id,1,2) = '3a')
"""


def of_broken(rule: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rule(broken(spark, sf_dir))


def of_inputs(rule: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rule(broken_inputs(spark, sf_dir))


def rule_input_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.input_targets(chunks_of(spark, sf_dir), broken_inputs(spark, sf_dir), PARENT_CHILD)


def rule_unknown_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.unknown_pending(broken_inputs(spark, sf_dir), inputs_of(chunks_of(spark, sf_dir)))


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their blocks of text as units (unit_id, content, path): a page is a row, and stays one."""
    pages = read(spark, sf_dir, "pages").select(text_of("page-", "page_id").alias("document_id"), F.coalesce("html", F.lit("")).alias("html"))
    block = pa.struct([("content", pa.string()), ("path", pa.list_(pa.string()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"content": c, "path": p} for c, p in U.parse_html(h)] for h in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["document_id"], b["version"], pa.array(found, pa.list_(block))], ["document_id", "version", "blocks"])

    rows = pages.select("document_id", X.sha256("html").alias("version"), "html")
    made = in_batches(rows, work, "document_id string, version string, blocks array<struct<content: string, path: array<string>>>")
    units = F.transform("blocks", lambda b, i: F.struct(X.unit_id(F.col("version"), i + 1, b["content"]).alias("unit_id"), b["content"].alias("content"), b["path"].alias("path")))
    return made.select("document_id", units.alias("units"))


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure-aware chunks of the whole texts of pages, under their headings of all levels."""
    found = chunking.structure_aware_rows(page_blocks(spark, sf_dir), CONFIG)
    return found.select("document_id", "chunk_id", F.col("sequence").cast("long").alias("sequence"), F.col("character_count").cast("long").alias("character_count"), F.size("source_unit_ids").cast("long").alias("units"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [vector_search_topk, search_isolation, batch_search_topk, visible_candidates, evidence_order_check, insert_sets, reset_visibility, cascade_delete, upsert_embeddings, publish_transition, active_uniqueness, profile_config_conflict, config_snapshots, model_keys, rule_vectors, rule_early_visible, rule_source_uri, rule_identifiers, rule_content_hash, rule_config_snapshots, rule_profiles, rule_other_documents, rule_other_sets, rule_semantic_paths, rule_metadata_objects, rule_embedding_records, unit_metadata, unit_preparation, document_identity, parent_chunks, child_chunks, chunk_links, chunk_statistics, embedding_inputs, embedding_inputs_structure, prepare_build_missing, index_result_counts, reconcile_deletes, reconcile_upserts, stale_embeddings, rule_input_targets, rule_unknown_pending, page_sections]
    return {f.__name__: f for f in named} | {
        "rule_duplicate_chunk_ids": of_broken(rules.duplicate_chunk_ids),
        "rule_duplicate_sequences": lambda spark, sf_dir: longs(rules.duplicate_sequences(broken(spark, sf_dir)), "sequence"),
        "rule_chunk_fields": of_broken(rules.chunk_fields),
        "rule_rune_counts": of_broken(rules.rune_counts),
        "rule_blank_units": of_broken(rules.blank_units),
        "rule_self_relations": of_broken(rules.self_relations),
        "rule_kinds": of_broken(lambda c: rules.kinds(c, PARENT_CHILD)),
        "rule_orphan_children": of_broken(rules.orphan_children),
        "rule_asymmetric_links": of_broken(rules.asymmetric_links),
        "rule_input_hashes": of_inputs(rules.input_hashes),
        "rule_model_spaces": of_inputs(rules.model_spaces),
        "rule_duplicate_inputs": of_inputs(rules.duplicate_inputs),
    }


_SIDE = """SELECT m.chunk_set_id, m.chunk_id FROM b m LEFT JOIN b o ON o.chunk_set_id = m.chunk_set_id AND o.chunk_id = m.{there}_chunk_id WHERE m.{there}_chunk_id IS NOT NULL AND NOT
 (m.kind IS NOT DISTINCT FROM o.kind AND m.level IS NOT DISTINCT FROM o.level AND m.document_id IS NOT DISTINCT FROM o.document_id AND m.parent_chunk_id IS NOT DISTINCT FROM o.parent_chunk_id AND m.chunk_id IS NOT DISTINCT FROM o.{back}_chunk_id)"""


_NUMBERED = "SELECT 'set-' || vec_id AS chunk_set_id, 'chunk-' || vec_id AS chunk_id FROM embeddings WHERE"


def oracle_sql() -> dict[str, str]:
    near = "SELECT *, list_cosine_distance(embedding::DOUBLE[], q) AS d FROM vis, q"
    shared = "SELECT *, substr(document_id, 10, 1) AS doc FROM i"
    return {
        "vector_search_topk": f"{VECTORS} SELECT chunk_set_id, chunk_id, document_id, source_uri, source_name, 'child' AS kind, 1 AS sequence, 'content of ' || v AS content, 3 AS token_count, '[\"unit-' || v || '\"]' AS source_unit_ids, '{{}}' AS metadata, round(d, 6) AS cosine_distance FROM ({near}) JOIN k ON model_key = key WHERE tenant_id = '{TENANT}' AND knowledge_base_id = '{KNOWLEDGE_BASE}' ORDER BY d, chunk_set_id, chunk_id LIMIT {TOP}",
        "search_isolation": f"{VECTORS} SELECT CASE WHEN tenant_id <> '{TENANT}' THEN 'tenant' WHEN knowledge_base_id <> '{KNOWLEDGE_BASE}' THEN 'knowledge base' WHEN status <> 'active' THEN status WHEN NOT searchable THEN 'not searchable' WHEN model_key <> key THEN 'model' ELSE 'visible' END AS excluded_by, count(*) AS candidates FROM i, k GROUP BY 1",
        "batch_search_topk": f"{VECTORS} SELECT query_id, rank, chunk_set_id, chunk_id, round(d, 6) AS cosine_distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, chunk_set_id, chunk_id) AS rank FROM (SELECT s.vec_id AS query_id, chunk_set_id, chunk_id, list_cosine_distance(vis.embedding::DOUBLE[], s.embedding::DOUBLE[]) AS d FROM vis JOIN k ON model_key = key, embeddings s WHERE s.vec_id % 20 = 0)) WHERE rank <= 5",
        "visible_candidates": f"{VECTORS} SELECT tenant_id, knowledge_base_id, model_key, count(*) AS candidates FROM vis GROUP BY ALL",
        "evidence_order_check": f"{VECTORS}, n AS (SELECT *, row_number() OVER (ORDER BY d, chunk_set_id, chunk_id) AS r FROM ({near}) JOIN k ON model_key = key), m AS (SELECT r * 10 - CASE WHEN r % 7 = 0 THEN 35 ELSE 0 END AS rank, r, chunk_set_id, chunk_id FROM n) SELECT rank, chunk_set_id, chunk_id FROM (SELECT *, lag(r) OVER (ORDER BY rank) AS b FROM m) WHERE b >= r",
        "insert_sets": f"{VECTORS} SELECT chunk_set_id AS id, CASE WHEN v % 3 = 0 THEN status ELSE 'building' END AS status FROM i",
        "reset_visibility": f"{VECTORS} SELECT chunk_set_id, chunk_id, searchable AND status <> 'building' AS searchable FROM i",
        "cascade_delete": f"{VECTORS} SELECT kind, chunk_set_id, chunk_id FROM i, (VALUES ('chunk'), ('vector')) AS t(kind) WHERE status <> 'retired'",
        "upsert_embeddings": "SELECT 'set-' || vec_id AS chunk_set_id, 'chunk-' || vec_id AS chunk_id, 'm' AS model_key, 'hash ' || t || ' ' || vec_id AS input_sha256, CASE WHEN vec_id % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS created_at, t::BIGINT AS updated_at FROM (SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END AS t FROM embeddings) WHERE vec_id % 2 = 0 OR vec_id % 3 = 0",
        "publish_transition": f"{VECTORS}, s AS ({shared}), f AS (SELECT tenant_id, knowledge_base_id, doc, min(chunk_set_id) AS id FROM s WHERE status = 'building' GROUP BY ALL) SELECT chunk_set_id AS id, s.tenant_id, s.knowledge_base_id, doc AS document_id, CASE WHEN f.id = chunk_set_id THEN 'active' WHEN f.id IS NOT NULL AND status = 'active' THEN 'retired' ELSE status END AS status FROM s LEFT JOIN f USING (tenant_id, knowledge_base_id, doc)",
        "active_uniqueness": f"{VECTORS} SELECT tenant_id, knowledge_base_id, doc AS document_id, 'parent_child' AS strategy_name, count(*) AS n FROM ({shared}) WHERE status = 'active' GROUP BY ALL HAVING count(*) > 1",
        "profile_config_conflict": "SELECT 'parent_child' AS strategy_name, 'profile-' || (vec_id % 7) AS profile_name, 'v' || (vec_id % 3) AS profile_version, count(DISTINCT CASE WHEN vec_id % 42 = 5 THEN 1000 ELSE 2000 END) AS configs FROM embeddings GROUP BY ALL HAVING configs > 1",
        "config_snapshots": """SELECT vec_id, '{"parent_max_runes":' || (vec_id + 2000) || ',"child_max_runes":' || (vec_id + 500) || ',"embedding_input_policy":"v1"}' AS parent_child, '{"max_runes":' || (vec_id + 1800) || ',"min_runes":' || (vec_id + 600) || ',"heading_context":"prepend","embedding_input_policy":"v1"}' AS structure_aware FROM embeddings""",
        "model_keys": "SELECT vec_id, 'model-' || (vec_id % 5) || ':' || sha256('model-' || (vec_id % 5) || chr(0) || (vec_id % 3 + 64) || chr(0) || 'cosine' || chr(0) || 'v' || vec_id) AS model_key FROM embeddings",
        "rule_vectors": f"{VECTORS} SELECT chunk_set_id, chunk_id FROM i WHERE v % 17 = 0 OR v % 19 = 0 OR v % 23 = 0",
        "rule_early_visible": f"{VECTORS} SELECT chunk_set_id, chunk_id FROM i WHERE status = 'building' AND searchable",
        "rule_identifiers": f"SELECT 'set-' || vec_id AS id FROM embeddings WHERE vec_id % 8 < 7 AND (vec_id // 8) % {len(IDENTIFIERS)} IN (2, 3, 4, 5)",
        "rule_content_hash": f"SELECT 'set-' || vec_id AS id FROM embeddings WHERE vec_id % {len(HASHES)} >= 2",
        "rule_config_snapshots": f"SELECT 'set-' || vec_id AS id FROM embeddings WHERE vec_id % {len(SNAPSHOTS)} >= 2",
        "rule_profiles": "SELECT 'set-' || vec_id AS id FROM embeddings WHERE vec_id % 10 < 3",
        "rule_other_documents": f"{_NUMBERED} vec_id % 9 IN (2, 3)",
        "rule_other_sets": f"{_NUMBERED} vec_id % 4 = 3",
        "rule_semantic_paths": f"{_NUMBERED} vec_id % 5 <> 0 AND vec_id % {len(PATHS)} >= 5",
        "rule_metadata_objects": f"{_NUMBERED} vec_id % {len(METADATA)} >= 3",
        "rule_embedding_records": "SELECT CASE WHEN v % 20 = 1 THEN 'no uuid' ELSE substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21,12) END AS chunk_set_id, CASE WHEN v % 20 = 2 THEN ' padded' ELSE 'chunk-' || v END AS chunk_id FROM (SELECT vec_id AS v, md5('set:' || vec_id) AS h FROM embeddings) WHERE v % 20 BETWEEN 1 AND 9",
        "unit_metadata": "SELECT sha256(sha256(text) || ':1:' || text) AS unit_id, lang AS language, 'synthetic://documents/' || doc_id AS source_uri, 'text/plain' AS mime_type, 'document-' || substr(sha256('synthetic://documents/' || doc_id), 1, 32) AS document_id, sha256(text) AS document_version_id, 'document' AS unit_type, '1' AS unit_index FROM documents WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''",
        "rule_source_uri": "SELECT vec_id AS id FROM embeddings WHERE vec_id % 12 IN (3, 4, 5, 6, 7, 8, 9, 10)",
        "unit_preparation": f"{CHUNKS} SELECT document_id, tenant_id, knowledge_base_id, content_sha256, unit_index::BIGINT AS unit_index, unit_id FROM u",
        "document_identity": "SELECT doc_id, 'document-' || substr(sha256('https://example.com/files/part-' || (doc_id % 50) || '.tar/Report ' || doc_id || '.md'), 1, 32) AS document_id, 'Report ' || doc_id || '.md' AS source_name, 'Report ' || doc_id AS title FROM documents",
        "parent_chunks": f"{CHUNKS} SELECT document_id, chunk_id, sequence, level::BIGINT AS level, character_count, token_count, content FROM c WHERE kind = 'parent'",
        "child_chunks": f"{CHUNKS} SELECT document_id, chunk_id, parent_chunk_id, sequence, level::BIGINT AS level, character_count, token_count, unit_id, content FROM c WHERE kind = 'child'",
        "chunk_links": f"{CHUNKS} SELECT chunk_id, previous_chunk_id, next_chunk_id FROM c WHERE kind = 'child'",
        "chunk_statistics": f"{CHUNKS} SELECT kind, count(*) AS chunks, sum(character_count)::BIGINT AS characters, max(character_count) AS longest FROM c GROUP BY kind",
        "embedding_inputs": f"{CHUNKS} SELECT chunk_set_id, chunk_id, embedding_text, input_sha256 FROM inp",
        "embedding_inputs_structure": "SELECT doc_id, sha256(CASE WHEN doc_id % 2 = 0 OR doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN 'A' || chr(10) || chr(10) || text ELSE 'A > B' || doc_id || chr(10) || chr(10) || text END) AS input_sha256 FROM documents",
        "prepare_build_missing": f"{CHUNKS} SELECT chunk_set_id, chunk_id, input_sha256 FROM inp WHERE NOT (substr(chunk_id,1,1) < '8') OR substr(chunk_id,1,2) IN ('1a', '2b')",
        "index_result_counts": f"{CHUNKS} SELECT c.chunk_set_id, count(*) AS chunk_count, count(*) FILTER (kind = 'child') AS embedding_count, count(*) FILTER (kind = 'child' AND substr(chunk_id,1,1) >= '8') AS generated_embedding_count, count(*) FILTER (kind = 'child' AND substr(chunk_id,1,1) < '8') AS reused_embedding_count FROM c GROUP BY 1",
        "reconcile_deletes": f"{CHUNKS} SELECT chunk_set_id, chunk_id FROM c WHERE substr(chunk_id,1,1) >= 'c'",
        "reconcile_upserts": f"{CHUNKS} SELECT chunk_set_id, chunk_id, character_count + CASE WHEN substr(chunk_id,1,1) >= '4' THEN 1 ELSE 0 END AS characters, (CASE WHEN substr(chunk_id,1,1) < '8' THEN 1 ELSE 2 END)::BIGINT AS created FROM c",
        "stale_embeddings": f"{CHUNKS} SELECT chunk_set_id, chunk_id, CASE WHEN substr(chunk_id,1,2) = '2b' THEN 'other' ELSE 'm' END AS model_key FROM inp WHERE substr(chunk_id,1,2) = '2b' OR substr(chunk_id,1,1) >= 'c'",
        "rule_input_targets": f"{BROKEN_INPUTS} SELECT chunk_set_id, chunk_id, 'unexpected' AS problem FROM j WHERE chunk_id = 'nowhere' UNION ALL SELECT chunk_set_id, chunk_id, 'missing' FROM inp WHERE substr(chunk_id,1,2) IN ('2a', '2f')",
        "rule_unknown_pending": f"{BROKEN_INPUTS} SELECT chunk_set_id, chunk_id FROM j WHERE NOT EXISTS (SELECT 1 FROM inp WHERE inp.chunk_set_id = j.chunk_set_id AND inp.chunk_id = j.chunk_id AND j.model_key = 'm' AND inp.embedding_text = j.embedding_text AND inp.input_sha256 = j.input_sha256)",
        "rule_duplicate_chunk_ids": f"{BROKEN} SELECT chunk_set_id, chunk_id, count(*) AS n FROM b GROUP BY ALL HAVING count(*) > 1",
        "rule_duplicate_sequences": f"{BROKEN} SELECT chunk_set_id, sequence, count(*) AS n FROM b GROUP BY ALL HAVING count(*) > 1",
        "rule_chunk_fields": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b WHERE regexp_replace(content, '^\\s+|\\s+$', '', 'g') = ''",
        "rule_rune_counts": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b WHERE character_count <> length(content)",
        "rule_blank_units": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b WHERE unit_id = ' '",
        "rule_self_relations": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b WHERE previous_chunk_id = chunk_id OR next_chunk_id = chunk_id OR parent_chunk_id = chunk_id",
        "rule_kinds": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b WHERE NOT ((kind = 'parent' AND level = 0 AND parent_chunk_id IS NULL) OR (kind = 'child' AND level = 1 AND parent_chunk_id IS NOT NULL))",
        "rule_orphan_children": f"{BROKEN} SELECT chunk_set_id, chunk_id FROM b m WHERE kind = 'child' AND NOT EXISTS (SELECT 1 FROM b t WHERE t.kind = 'parent' AND t.level = 0 AND t.parent_chunk_id IS NULL AND t.chunk_set_id = m.chunk_set_id AND t.chunk_id = m.parent_chunk_id AND t.document_id = m.document_id)",
        "rule_asymmetric_links": f"{BROKEN} {_SIDE.format(there='next', back='previous')} UNION {_SIDE.format(there='previous', back='next')}",
        "rule_input_hashes": f"{BROKEN_INPUTS} SELECT chunk_set_id, chunk_id FROM j WHERE input_sha256 <> sha256(embedding_text)",
        "rule_model_spaces": f"{BROKEN_INPUTS} SELECT chunk_set_id, count(DISTINCT model_key) AS spaces FROM j GROUP BY 1 HAVING spaces <> 1",
        "rule_duplicate_inputs": f"{BROKEN_INPUTS} SELECT chunk_set_id, chunk_id, model_key, count(*) AS n FROM j GROUP BY ALL HAVING count(*) > 1",
    }

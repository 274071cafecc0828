"""The integrity rules, each a query that returns what breaks it; right data give no rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidBuild
from ..functions import canonical as J
from ..functions import exprs as X
from .chunking import PARENT_CHILD, STRUCTURE_AWARE
from .mapping import BuildData, embeddable
from .ordering import numbered

SET, CHUNK = "chunk_set_id", ["chunk_set_id", "chunk_id"]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(True)) for c in conditions])


def blank_or_padded_scope(sets: DataFrame) -> DataFrame:
    return sets.filter(_any([X.padded(c) for c in ("id", "tenant_id", "knowledge_base_id", "document_id", "source_name", "strategy_name", "profile_name", "profile_version")])).select("id")


def source_uri_policy(sets: DataFrame) -> DataFrame:
    return sets.filter(X.bad_uri(F.col("source_uri"))).select("id")


def content_hash_format(sets: DataFrame) -> DataFrame:
    return sets.filter(_any([~F.col("content_sha256").rlike(X.HEX64)])).select("id")


#: The keys of a configuration snapshot; those that each strategy needs to be whole numbers of 1 or more; the policy.
NUMBERS = {PARENT_CHILD: ("parent_max_runes", "child_max_runes"), STRUCTURE_AWARE: ("max_runes", "min_runes")}
TEXTS, POLICY, CONTEXTS = ("heading_context", "embedding_input_policy"), "v1", ("prepend", "metadata_only")


def config_snapshots(sets: DataFrame) -> DataFrame:
    """Sets whose stored configuration isn't an object, has an unknown key or a value of the wrong type, lacks what its
    strategy needs, has what only another one needs (0 and "" count as absent), or another policy than v1."""
    whole = sets.withColumn("snapshot", F.try_parse_json("config"))
    value = lambda k: F.try_variant_get("snapshot", f"$.{k}", "variant")
    kind = lambda k: F.coalesce(F.schema_of_variant(value(k)), F.lit("VOID"))
    number = lambda k: F.coalesce(F.try_variant_get("snapshot", f"$.{k}", "long"), F.lit(0))
    text = lambda k: F.coalesce(F.try_variant_get("snapshot", f"$.{k}", "string"), F.lit(""))
    numbers = [k for keys in NUMBERS.values() for k in keys]
    unknown = F.size(F.array_except(F.coalesce(F.json_object_keys("config"), F.array(F.lit("?"))), F.array(*map(F.lit, [*numbers, *TEXTS])))) > 0
    wrong = [~J.is_object(F.col("config")), unknown, *(~kind(k).isin("BIGINT", "VOID") for k in numbers), *(~kind(k).isin("STRING", "VOID") for k in TEXTS), text("embedding_input_policy") != POLICY]

    def fits(strategy: str) -> Column:
        own = [number(k) >= 1 if k in NUMBERS[strategy] else number(k) == 0 for k in numbers]
        context = text("heading_context")
        rest = [context == ""] if strategy == PARENT_CHILD else [context.isin(*CONTEXTS), number("min_runes") <= number("max_runes")]
        return (F.col("strategy_name") == strategy) & reduce(lambda a, b: a & b, [*own, *rest])

    return whole.filter(_any([*wrong, ~(fits(PARENT_CHILD) | fits(STRUCTURE_AWARE))])).select("id")


def profile_mismatches(results: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets whose chunking result (id, strategy_name, profile_name, profile_version) was made under another profile or strategy."""
    made = results.select("id", *(F.col(c).alias(f"made {c}") for c in ("strategy_name", "profile_name", "profile_version")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"made {c}")) for c in ("strategy_name", "profile_name", "profile_version")])
    return sets.join(made, "id").filter(~same).select("id")


def other_documents(chunks: DataFrame, sets: DataFrame) -> DataFrame:
    """Chunks of another document than their set's."""
    own = sets.select(F.col("id").alias(SET), F.col("document_id").alias("set document"))
    return chunks.join(own, SET).filter(~F.col("document_id").eqNullSafe(F.col("set document"))).select(*CHUNK)


def other_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Chunks or inputs of a set that isn't among these."""
    return rows.join(sets.select(F.col("id").alias(SET)), SET, "left_anti").select(*CHUNK)


def semantic_paths(chunks: DataFrame, sets: DataFrame) -> DataFrame:
    """Chunks of sets that prepend headings from metadata, whose heading path is there but isn't an array of texts, none blank."""
    context = F.get_json_object("config", "$.heading_context")
    asked = chunks.join(sets.filter(context == "metadata_only").select(F.col("id").alias(SET)), SET, "left_semi")
    found = F.get_json_object("metadata", "$.semantic_path")
    texts = F.from_json(found, "array<string>")
    right = (found == "[]") | ((F.schema_of_variant(F.try_parse_json(found)) == "ARRAY<STRING>") & F.forall(texts, lambda t: ~X.blank(t)))
    return asked.filter(found.isNotNull() & ~F.coalesce(right, F.lit(False))).select(*CHUNK)


def duplicate_chunk_ids(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(*CHUNK).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_sequences(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(SET, "sequence").agg(F.count("*").alias("n")).filter("n > 1 or sequence is null or sequence < 1")


def chunk_fields(chunks: DataFrame) -> DataFrame:
    """Identifiers, content, kind and numbers of a chunk by itself."""
    numbers = (F.col("level") < 0) | (F.col("character_count") < 1) | (F.col("token_count") < 0)
    return chunks.filter(_any([X.padded("chunk_id"), X.blank("content"), X.blank("kind"), numbers])).select(*CHUNK)


def rune_counts(chunks: DataFrame) -> DataFrame:
    return chunks.filter(_any([F.col("character_count") != F.length("content")])).select(*CHUNK)


def blank_units(chunks: DataFrame) -> DataFrame:
    return chunks.filter(_any([F.size("source_unit_ids") < 1, F.exists("source_unit_ids", lambda u: X.blank(u))])).select(*CHUNK)


def metadata_objects(chunks: DataFrame) -> DataFrame:
    return chunks.filter(~J.is_object(F.col("metadata"))).select(*CHUNK)


def self_relations(chunks: DataFrame) -> DataFrame:
    def wrong(c: str) -> Column:
        return F.coalesce(F.col(c).isNotNull() & ((F.col(c) == F.col("chunk_id")) | X.blank(c)), F.lit(False))

    return chunks.filter(wrong("parent_chunk_id") | wrong("previous_chunk_id") | wrong("next_chunk_id")).select(*CHUNK)


def kinds(chunks: DataFrame, strategy: str) -> DataFrame:
    """Parents are on level 0 without parent, children on level 1 with one; structure chunks on level 0 without."""
    bare = F.col("parent_chunk_id").isNull()
    if strategy == PARENT_CHILD:
        right = ((F.col("kind") == "parent") & (F.col("level") == 0) & bare) | ((F.col("kind") == "child") & (F.col("level") == 1) & ~bare)
    else:
        right = (F.col("kind") == "structure") & (F.col("level") == 0) & bare
    return chunks.filter(~F.coalesce(right, F.lit(False))).select(*CHUNK)


def orphan_children(chunks: DataFrame) -> DataFrame:
    """Children whose parent isn't a level-0 parent of the same set and document, itself without parent."""
    tops = chunks.filter("kind = 'parent' and level = 0 and parent_chunk_id is null").select(SET, F.col("chunk_id").alias("parent_chunk_id"), "document_id")
    return chunks.filter("kind = 'child'").join(tops, [SET, "parent_chunk_id", "document_id"], "left_anti").select(*CHUNK)


def asymmetric_links(chunks: DataFrame) -> DataFrame:
    """Neighbours that are missing, of another kind, level, document or parent, or that don't point back. One join for both sides."""
    same = ("kind", "level", "document_id", "parent_chunk_id")
    fields = chunks.select(SET, "chunk_id", *same, "previous_chunk_id", "next_chunk_id")
    other = fields.select(SET, F.col("chunk_id").alias("there"), *(F.col(c).alias(f"o_{c}") for c in (*same, "previous_chunk_id", "next_chunk_id")))
    sides = F.array(F.struct(F.col("next_chunk_id").alias("there"), F.lit(True).alias("forward")), F.struct(F.col("previous_chunk_id").alias("there"), F.lit(False).alias("forward")))
    mine = fields.select(SET, "chunk_id", *same, F.explode(F.filter(sides, lambda s: s["there"].isNotNull())).alias("side")).select(SET, "chunk_id", *same, "side.*")
    back = F.when(F.col("forward"), F.col("o_previous_chunk_id")).otherwise(F.col("o_next_chunk_id"))
    right = reduce(lambda a, b: a & b, [*(F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in same), F.col("chunk_id").eqNullSafe(back)])
    return mine.join(other, [SET, "there"], "left").filter(~right).select(*CHUNK).distinct()


def input_targets(chunks: DataFrame, inputs: DataFrame, strategy: str) -> DataFrame:
    """Inputs without an embeddable chunk, and embeddable chunks without input; a null id has no counterpart.

    Either side is read once and counted by id, so an id that very many rows have is one row of what is exchanged.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    wanted = chunks.filter(embeddable(strategy)).select(*CHUNK, one.alias("wanted"), zero.alias("given"))
    counts = wanted.union(inputs.select(*CHUNK, zero, one)).groupBy(*CHUNK).agg(F.sum("wanted").alias("wanted"), F.sum("given").alias("given"))
    apart = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in CHUNK])
    times = lambda name, n, other: F.array_repeat(F.lit(name), F.when(apart | (F.col(other) == 0), F.col(n)).otherwise(0).cast("int"))
    return counts.select(*CHUNK, F.explode(F.concat(times("unexpected", "given", "wanted"), times("missing", "wanted", "given"))).alias("problem"))


def input_hashes(inputs: DataFrame) -> DataFrame:
    return inputs.filter(_any([X.blank("model_key"), X.blank("embedding_text"), ~F.col("input_sha256").rlike(X.HEX64), F.col("input_sha256") != X.sha256("embedding_text")])).select(*CHUNK)


def model_spaces(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy(SET).agg(F.count_distinct("model_key").alias("spaces")).filter("spaces <> 1")


def duplicate_inputs(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy(*CHUNK, "model_key").agg(F.count("*").alias("n")).filter("n > 1")


def unknown_pending(pending: DataFrame, inputs: DataFrame) -> DataFrame:
    return pending.join(inputs, [*CHUNK, "model_key", "embedding_text", "input_sha256"], "left_anti").select(*CHUNK)


def bad_vector(dimensions: int) -> Column:
    return _any([F.size("embedding") != dimensions, ~X.finite(F.col("embedding"))])


def vectors(embeddings: DataFrame, dimensions: int) -> DataFrame:
    return embeddings.filter(bad_vector(dimensions)).select(*CHUNK)


def bad_record(dimensions: int) -> Column:
    """What is wrong with one record by itself."""
    wrong = [~F.col(SET).rlike(X.UUID), X.padded("chunk_id"), X.padded("model_key"), X.blank("embedding_text"), ~F.col("input_sha256").rlike(X.HEX64), F.col("embedding_token_count") < 1]
    return _any(wrong) | bad_vector(dimensions)


def embedding_records(embeddings: DataFrame, dimensions: int) -> DataFrame:
    return embeddings.filter(bad_record(dimensions)).select(*CHUNK).union(duplicate_inputs(embeddings).select(*CHUNK)).distinct()


def profile_configs(sets: DataFrame) -> DataFrame:
    return sets.groupBy("strategy_name", "profile_name", "profile_version").agg(F.count_distinct("config").alias("configs")).filter("configs > 1")


def active_scopes(sets: DataFrame) -> DataFrame:
    return sets.filter("status = 'active'").groupBy("tenant_id", "knowledge_base_id", "document_id", "strategy_name").agg(F.count("*").alias("n")).filter("n > 1")


def early_visible(sets: DataFrame, embeddings: DataFrame) -> DataFrame:
    building = sets.filter("status = 'building'").select(F.col("id").alias(SET))
    return embeddings.filter("searchable").join(building, SET, "left_semi").select(*CHUNK)


def evidence_order(evidence: DataFrame) -> DataFrame:
    """Ranked rows (rank, cosine_distance, chunk_set_id, chunk_id) that stand before their place or repeat a candidate.

    The rows are numbered over range partitions, and each one meets the one before it by its number: no task has all rows.
    """
    rows = numbered(evidence.select("rank", "cosine_distance", *CHUNK), ["rank", "cosine_distance", *CHUNK]).withColumn("key", F.struct("cosine_distance", *CHUNK))
    before = rows.select((F.col("number") + 1).alias("number"), F.col("key").alias("before"))
    return rows.join(before, "number").filter(F.col("before") >= F.col("key")).select("rank", *CHUNK)


def checks(build: BuildData, strategy: str) -> dict[str, Callable[[], DataFrame]]:
    s, c, i = build.sets, build.chunks, build.inputs
    return {
        "R-SPEC": lambda: blank_or_padded_scope(s), "R-URI": lambda: source_uri_policy(s), "R-SHA": lambda: content_hash_format(s), "R-CFG2": lambda: config_snapshots(s),
        "R-CH7": lambda: other_documents(c, s), "R-CH8": lambda: other_sets(c.select(*CHUNK).union(i.select(*CHUNK)), s), "R-PATH": lambda: semantic_paths(c, s),
        "R-CH1": lambda: chunk_fields(c), "R-CH2": lambda: duplicate_chunk_ids(c), "R-CH3": lambda: duplicate_sequences(c), "R-CH5": lambda: rune_counts(c),
        "R-CH6": lambda: blank_units(c), "R-CH9": lambda: metadata_objects(c), "R-CH10": lambda: self_relations(c), "R-KIND": lambda: kinds(c, strategy),
        "R-PC2": lambda: orphan_children(c), "R-ADJ": lambda: asymmetric_links(c), "R-IN1": lambda: input_targets(c, i, strategy),
        "R-IN2": lambda: input_hashes(i), "R-IN3": lambda: model_spaces(i), "R-IN4": lambda: duplicate_inputs(i),
    }


def validate_build(build: BuildData, strategy: str) -> None:
    """Raises with the names of all broken rules. One job: each rule's rows are counted in one union."""
    if build.chunks.isEmpty() or build.inputs.isEmpty():
        raise InvalidBuild("R-EMPTY: there is nothing to embed")
    counted = [q().limit(1).select(F.lit(name).alias("rule")) for name, q in checks(build, strategy).items()]
    broken = sorted(r.rule for r in reduce(DataFrame.union, counted).collect())
    if broken:
        raise InvalidBuild(", ".join(broken))

"""Blocks of vectors, the index by lists, keywords, fusion and contexts: against SQL, plain loops and the exact search."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery import queries as engine
from orrery import retrieval
from orrery.errors import InvalidConfig
from orrery.operators import ann, blocks, context, keyword, search
from orrery.sources.shared import scratch

from .conftest import DATA, oracle_rows, rows

SETS = "id string, tenant_id string, knowledge_base_id string, document_id string, source_uri string, source_name string, status string"
VECTORS = "chunk_set_id string, chunk_id string, model_key string, embedding array<float>, searchable boolean"


@pytest.mark.parametrize("name", sorted(retrieval.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert rows(retrieval.queries()[name](spark, DATA)) == oracle_rows(duck, retrieval.oracle_sql()[name])


# ---- blocks


def some_vectors(spark, n=400, dimensions=8, seed=1):
    rng = np.random.default_rng(seed)
    made = [rng.normal(size=dimensions).astype("float32").tolist() for _ in range(n // 2)]
    made += [made[i % 20] for i in range(n // 4)]  # copies tie
    made += [[0.0] * dimensions, [1.0] * (dimensions - 1), [float("nan")] + [1.0] * (dimensions - 1), None]
    found = [(f"s{i % 7}", f"c{i:04}", "m" if i % 5 else "o", v, i % 6 != 0) for i, v in enumerate(made)]
    return spark.createDataFrame(found, VECTORS)


def test_blocks_equal_the_functions_to_the_last_digit(spark, monkeypatch):
    vectors = some_vectors(spark).repartition(3)
    queries = vectors.filter("embedding is not null and size(embedding) = 8 and not isnan(embedding[0])").limit(30).select(F.substring("chunk_id", 2, 4).cast("int").alias("query_id"), "model_key", F.col("embedding").alias("vector"))
    queries = spark.createDataFrame(queries.collect(), queries.schema)
    usual = search.search_many(queries, vectors.filter("size(embedding) = 8 and not isnan(embedding[0])"), 6).collect()
    assert len(usual) > 100
    for size in (blocks.BLOCK_BYTES, 8 * 8 * 10):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
        monkeypatch.setattr(blocks, "PRODUCT_BYTES", size)
        assert sorted(blocks.search_blocks(queries, vectors, 6, 8).collect()) == sorted(usual)


def test_blocks_without_rows(spark):
    vectors = some_vectors(spark)
    queries = vectors.limit(3).select(F.lit("q").alias("query_id"), "model_key", F.col("embedding").alias("vector"))
    assert blocks.search_blocks(queries.filter("false"), vectors, 3, 8).collect() == []
    assert blocks.search_blocks(queries, vectors.filter("false"), 3, 8).collect() == []


# ---- the index


def sets_of(spark, active=("s0", "s1", "s2", "s3", "s4")):
    return spark.createDataFrame([(f"s{i}", "t", "kb" if i < 6 else "other", "d", "u", "n", "active" if f"s{i}" in active else "retired") for i in range(7)], SETS)


@pytest.fixture(scope="module")
def index(spark):
    return ann.VectorIndex.build(some_vectors(spark), scratch(spark, "test-index"), ann.IndexConfig(8, lists=12, sample=30, rounds=4))


def test_index_has_every_vector_with_a_direction(spark, index):
    want = some_vectors(spark).filter("embedding is not null and size(embedding) = 8 and not isnan(embedding[0])")
    want = sorted(r.chunk_id for r in want.collect() if any(r.embedding))
    assert sorted(r.chunk_id for r in index.vectors.collect()) == want and 1 < index.lists <= 12
    again = ann.VectorIndex.load(spark, index.path)
    assert np.array_equal(again.centroids, index.centroids)


def test_index_with_all_lists_is_the_exact_search(spark, index):
    queries = some_vectors(spark, seed=2).limit(15).select("chunk_id", "model_key", F.col("embedding").alias("vector")).withColumnRenamed("chunk_id", "query_id")
    exact = search.search_many(queries, search.visible(sets_of(spark), index.vectors), 5)
    assert sorted(index.search_many(queries, sets_of(spark), 5, index.lists).collect()) == sorted(exact.collect())


def test_recall_of_the_index(spark):
    """At least 0.9 of the exact search's rows, from as many lists as measuring other queries says; the given vectors have hardly any clusters."""
    found = retrieval.index_search_recall(spark, DATA).agg(F.sum("hits") / F.sum("wanted")).first()[0]
    assert found >= 0.9


def test_clusters_need_few_lists(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(20, 16))
    rows = [(f"s{i % 5}", f"c{i}", "m", (middles[i % 20] + rng.normal(size=16) / 10).tolist(), True) for i in range(1000)]
    df = spark.createDataFrame(rows, VECTORS)
    index = ann.VectorIndex.build(df, scratch(spark, "test-clusters"), ann.IndexConfig(16, lists=32))
    queries = df.limit(40).select("chunk_id", "model_key", F.col("embedding").alias("vector")).withColumnRenamed("chunk_id", "query_id")
    probes = index.probes_for(queries, sets_of(spark), 5)
    assert probes <= 6
    exact = search.search_many(queries, search.visible(sets_of(spark), index.vectors), 5)
    assert ann.recall(index.search_many(queries, sets_of(spark), 5, probes), exact).agg(F.sum("hits") / F.sum("wanted")).first()[0] >= 0.95


def test_a_small_scope_loses_nothing(spark, index):
    """One probe finds too few in a scope of few vectors: more lists are read until there are enough, or all."""
    sets = sets_of(spark, ("s6",))
    for probes in (1, index.lists):
        request = search.SearchRequest("t", "other", "m", some_vectors(spark).first().embedding, 20, 8)
        got = index.search(sets, request, probes)
        everything = search.ranked(search.visible(sets.filter("knowledge_base_id = 'other'"), index.vectors.filter("model_key = 'm'")), request.vector, 20)
        assert got.count() == min(20, everything.count())
        if probes == index.lists:
            assert [r.chunk_id for r in got.collect()] == [r.chunk_id for r in everything.collect()]


def test_index_reads_probed_lists_alone(spark, index):
    queries = some_vectors(spark, seed=2).limit(2).select("chunk_id", "model_key", F.col("embedding").alias("vector")).withColumnRenamed("chunk_id", "query_id")
    plan = index.search_many(queries, sets_of(spark), 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert len(re.search(r"PartitionFilters: \[[^\]]*list#\d+ IN \(([\d,]+)\)", plan)[1].split(",")) <= 4 < index.lists


def test_index_settings():
    for wrong in ({"dimensions": 0}, {"dimensions": 8, "lists": 0}, {"dimensions": 1536, "lists": 100_000}):
        with pytest.raises(InvalidConfig):
            ann.IndexConfig(**wrong)


def test_a_list_with_very_many_copies(spark):
    rows = [("s0", f"c{i:05}", "m", [1.0, 0.0, 0.0], True) for i in range(3000)] + [("s1", f"d{i:03}", "m", [math.cos(i), math.sin(i), 0.5], True) for i in range(200)]
    index = ann.VectorIndex.build(spark.createDataFrame(rows, VECTORS), scratch(spark, "test-copies"), ann.IndexConfig(3, lists=8))
    assert index.vectors.count() == 3200 and index.lists > 1
    queries = spark.createDataFrame([(1, "m", [1.0, 0.0, 0.0])], "query_id int, model_key string, vector array<float>")
    assert [r.chunk_id for r in index.search_many(queries, sets_of(spark), 3, 1).orderBy("rank").collect()] == ["c00000", "c00001", "c00002"]


# ---- keywords

CHUNKS = "chunk_set_id string, chunk_id string, content string, parent_chunk_id string, previous_chunk_id string, next_chunk_id string, sequence int, token_count int"


def chunks_of(spark, texts):
    return spark.createDataFrame([(f"s{i % 4}", f"c{i}", t, f"p{i // 4}", f"c{i - 4}" if i >= 4 else None, f"c{i + 4}", i // 4 + 1, len((t or "").split())) for i, t in enumerate(texts)], CHUNKS)


def plain_bm25(texts, query, seen):
    words = {i: re.findall(r"[^\W_]+", (t or "").lower()) for i, t in enumerate(texts)}
    have = {i: w for i, w in words.items() if w and i in seen}
    mean = sum(map(len, have.values())) / len(have)
    out = Counter()
    for q in dict.fromkeys(re.findall(r"[^\W_]+", query.lower())):
        df = sum(q in w for w in have.values())
        for i, w in have.items():
            if tf := w.count(q):
                out[i] += round(math.log(1 + (len(have) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean)) * 1e9)
    return out


def test_bm25_equals_plain_loops(spark):
    rng = random.Random(4)
    vocabulary = "Äpfel und birnen x1 straße the quick brown fox 42".split()
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) + rng.choice(["", "!", " -"]) for _ in range(60)] + [None, "", "...", "fox fox", "fox fox"]
    chunks = chunks_of(spark, texts)
    sets = spark.createDataFrame([(f"s{i}", "t", "kb", "d", "u", "n", "active" if i != 3 else "building") for i in range(4)], SETS)
    seen = keyword.visible(keyword.postings(chunks), sets, chunks.filter("chunk_id = 'c0'"))
    asked = [(1, "Quick, QUICK fox!"), (2, "äpfel straße 42"), (3, "nothing here"), (4, ""), (5, None), (6, "the x1 und")]
    queries = spark.createDataFrame([(i, "t", "kb", q) for i, q in asked] + [(7, "t", "else", "fox")], "query_id int, tenant_id string, knowledge_base_id string, query string")
    shown = {i for i in range(len(texts)) if i % 4 != 3 and i != 0}
    got = {(r.query_id, r.chunk_id): r.score for r in keyword.scored(queries, seen).collect()}
    want = {(q, f"c{i}"): s for q, text in asked for i, s in plain_bm25(texts, text or "", shown).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 4 for k in got)
    top = keyword.search_keyword(queries, seen, 3).orderBy("query_id", "rank").collect()
    assert all(r.rank <= 3 for r in top) and {r.query_id for r in top} == {1, 2, 6}
    ties = [(r.chunk_set_id, r.chunk_id) for r in top if r.query_id == 1]
    assert ties == sorted(ties) or len({got[1, c] for _, c in ties}) > 1


def test_common_terms_are_not_gathered(spark):
    """The postings stay where they are: the queries' terms are sent to them."""
    seen = keyword.visible(keyword.postings(chunks_of(spark, ["a b"] * 50)), sets_of(spark))
    queries = spark.createDataFrame([(1, "t", "kb", "a")], "query_id int, tenant_id string, knowledge_base_id string, query string")
    plan = keyword.scored(queries, seen)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"hashpartitioning\(term", plan)


# ---- fusion and contexts

RANKED = "query_id int, rank int, chunk_set_id string, chunk_id string"


def test_fusion_keeps_what_one_ranking_has(spark):
    a = spark.createDataFrame([(1, 1, "s", "a"), (1, 2, "s", "b"), (2, 1, "s", "a")], RANKED)
    b = spark.createDataFrame([(1, 1, "s", "b"), (1, 2, "s", "c"), (3, 5, "s", "z")], RANKED)
    share = lambda r: 1_000_000_000 // (60 + r)
    got = [tuple(r) for r in context.fused(a, b, limit=3).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, "s", "b", share(2) + share(1)), (1, 2, "s", "a", share(1)), (1, 3, "s", "c", share(2)), (2, 1, "s", "a", share(1)), (3, 1, "s", "z", share(5))]
    assert context.fused(a, limit=1).count() == 2


FOUND = "query_id int, rank int, chunk_set_id string, chunk_id string, score long"


def test_parents_take_their_best_child(spark):
    chunks = chunks_of(spark, ["t"] * 12).withColumn("parent_chunk_id", F.when(F.col("chunk_id") != "c0", F.col("parent_chunk_id")))
    found = spark.createDataFrame([(1, 1, "s0", "c8", 9), (1, 2, "s1", "c5", 8), (1, 3, "s0", "c0", 7), (1, 4, "s1", "c1", 6)], FOUND)
    got = [tuple(r) for r in context.parents(found, chunks).orderBy("rank").collect()]
    assert got == [(1, 1, "s0", "p2", 9, 1), (1, 2, "s1", "p1", 8, 1), (1, 3, "s0", "c0", 7, 1), (1, 4, "s1", "p0", 6, 1)]
    both = spark.createDataFrame([(1, 1, "s0", "c4", 5), (1, 2, "s0", "c4", 3)], FOUND)
    assert [tuple(r) for r in context.parents(both, chunks).collect()] == [(1, 1, "s0", "p1", 5, 2)]


def test_neighbours_stay_in_their_section_and_set(spark):
    texts = [f"w{i} x y" for i in range(16)]
    chunks = chunks_of(spark, texts).withColumn("section", F.when(F.col("sequence") <= 2, "one").when(F.col("sequence") == 3, F.lit(None)).otherwise("two"))
    found = spark.createDataFrame([(1, 1, "s0", "c4", 9), (1, 2, "s0", "c0", 8), (1, 3, "s1", "c9", 7), (2, 1, "s0", "c12", 5)], FOUND)
    got = sorted((r.query_id, r["rank"], r.chunk_id, r.hop, r.score) for r in context.with_neighbours(found, chunks).collect())
    assert got == [(1, 1, "c4", 0, 9), (1, 2, "c0", 0, 8), (1, 3, "c9", 0, 7), (2, 1, "c12", 0, 5)]
    got = sorted((r.query_id, r["rank"], r.chunk_id, r.hop, r.score) for r in context.with_neighbours(found, chunks.withColumn("section", F.lit(None).cast("string"))).collect())
    assert got == [(1, 1, "c4", 0, 9), (1, 1, "c8", 1, 9), (1, 2, "c0", 0, 8), (1, 3, "c13", 1, 7), (1, 3, "c5", -1, 7), (1, 3, "c9", 0, 7), (2, 1, "c12", 0, 5), (2, 1, "c8", -1, 5)]


def test_budget_ends_a_context(spark):
    chunks = chunks_of(spark, ["a b c", "d", "e f g h", "i"])
    found = spark.createDataFrame([(1, 1, "s0", "c0", 9, 0), (1, 2, "s1", "c1", 8, 0), (1, 3, "s2", "c2", 7, 0), (1, 4, "s3", "c3", 6, 0)], FOUND + ", hop int")
    for budget, want in ((2, []), (3, ["c0"]), (7, ["c0", "c1"]), (8, ["c0", "c1", "c2"]), (99, ["c0", "c1", "c2", "c3"])):
        got = context.within_budget(found, chunks, budget).orderBy("place").collect()
        assert [r.chunk_id for r in got] == want and all(r.tokens <= budget for r in got)
    assert engine.TOP == 20

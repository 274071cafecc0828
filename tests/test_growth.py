"""What keeps the disk, memory and time of queries in proportion to their input."""

import time

import numpy as np
from pyspark.sql import functions as F

from orrery import queries, retrieval
from orrery.functions import exprs as X
from orrery.operators import ann, blocks, chunking, keyword, reconcile, rules, search
from orrery.sources import shared, units as U
from orrery.sources.shared import scratch

from .conftest import DATA


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


TEXTS = [(1, "a b\n" * 700, "en", "s"), (2, " " * 2100 + "x", "en", "s"), (3, "x" + " 　" * 1300 + "é" * 400, "de", "s"), (4, " 　\n", "de", "s"), (5, "", "de", "s"), (6, None, "de", "s"), (7, "y" * 2000, "fr", "t")]


def test_chunks_in_rows(spark):
    """Documents of one row give the chunks that grouping gives, without a shuffle."""
    given = U.of_table(documents(spark, TEXTS))
    slow, fast = chunking.parent_child(U.prepared(given)), chunking.parent_child_rows(U.prepared_rows(given))
    assert sorted(map(str, slow.select(fast.columns).collect())) == sorted(map(str, fast.collect()))
    assert "Exchange" not in plan_of(fast)


SPACED = "\t\n\x0b\f\r \x85\xa0\u1680\u180e\u2000\u2005\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"


def test_chunks_in_rows_of_odd_texts(spark):
    """Rare white space, controls, code points beyond the first plane, blank windows, cuts inside words and sizes that don't divide."""
    rng = np.random.default_rng(3)
    letters = [*SPACED, *"\x00\x1c\x1d\x1e\x1f\x7faé𝄞:字"]
    texts = ["".join(rng.choice(letters, n)) for n in (1, 2, 3, 7, 12, 13, 14, 200, 900)]
    texts += [c * 40 + d + c * 40 for c in " \u3000\x1c" for d in "a\x1f "] + ["\x1c \x1d", "a" * 99, *SPACED]
    given = U.of_table(documents(spark, [(i if i else None, t, "en", "s") for i, t in enumerate(texts)]))
    for config in (chunking.ChunkConfig(parent_max=13, child_max=5), chunking.ChunkConfig(parent_max=40, child_max=40), chunking.ChunkConfig(parent_max=20, child_max=1)):
        slow, fast = chunking.parent_child(U.prepared(given), config), chunking.parent_child_rows(U.prepared_rows(given), config)
        assert [(f.name, f.dataType) for f in fast.schema] == [(f.name, f.dataType) for f in slow.schema]
        assert sorted(map(str, slow.collect())) == sorted(map(str, fast.collect()))


def test_long_texts_are_cut_in_proportion(spark):
    """One text of four million characters takes about as long as four hundred of ten thousand; its windows don't each walk all of it."""

    def seconds(n, text):
        rows = spark.range(n, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit(text[:10]), len(text) // 10).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
        began = time.perf_counter()
        made = rules.chunk_fields(chunking.parent_child_rows(U.prepared_rows(U.of_table(rows))).withColumn("chunk_set_id", F.col("document_id")))
        assert made.count() == 0
        return time.perf_counter() - began

    seconds(400, "ab cdé fgh" * 1000)
    short, long = seconds(400, "ab cdé fgh" * 1000), seconds(1, "ab cdé fgh" * 400_000)
    assert long < 3 * short + 2


def test_chunks_of_a_file_of_one_row_group(spark, tmp_path, monkeypatch):
    """Documents that one task would read alone are dealt before they are cut; those in even parts stay where they are."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/one/documents.parquet")
    rows.repartition(4).write.parquet(f"{tmp_path}/four/documents.parquet")
    monkeypatch.setattr(queries, "ALONE", 50, raising=False)
    one, four = queries.chunks_of(spark, f"{tmp_path}/one"), queries.chunks_of(spark, f"{tmp_path}/four")
    assert one.select(F.spark_partition_id()).distinct().count() > 1
    assert "Exchange" not in plan_of(four)
    assert sorted(map(str, one.collect())) == sorted(map(str, four.collect()))
    monkeypatch.setattr(queries, "ALONE", 400, raising=False)
    assert "Exchange" not in plan_of(queries.chunks_of(spark, f"{tmp_path}/one"))
    rows.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.chunks_of(spark, f"{tmp_path}/none").count() == 0


def test_chunks_of_repeated_documents(spark, tmp_path):
    """Rows of one id are still numbered together."""
    rows = documents(spark, [*TEXTS, (7, "z" * 600, "fr", "t"), (None, "p", "fr", "t"), (None, "q", "fr", "t")])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.chunks_of(spark, str(tmp_path))
    expected = chunking.parent_child(U.prepared(U.of_table(rows)))
    assert sorted(map(str, found.drop("chunk_set_id").collect())) == sorted(map(str, expected.collect()))
    assert found.filter("document_id is null").count() == 4


def test_blank(spark):
    texts = spark.createDataFrame([("",), (" ",), ("　 \n",), (" a ",), ("​",), (None,)], "t string")
    assert [r[0] for r in texts.select(X.blank("t")).collect()] == [True, True, True, False, False, True]


def test_postings_without_shuffle(spark):
    chunks = spark.createDataFrame([("s", "c", "b a B, é"), ("s", "d", " "), ("s", "e", None), ("t", "c", "a")], "chunk_set_id string, chunk_id string, content string")
    found = keyword.postings(chunks)
    assert sorted(map(tuple, found.collect())) == [("s", "c", "a", 1, 4), ("s", "c", "b", 2, 4), ("s", "c", "é", 1, 4), ("t", "c", "a", 1, 1)]
    assert "Exchange" not in plan_of(found)
    few = keyword.counted(chunks, ["b", "nowhere"]).collect()
    assert [(r.length, [tuple(f) for f in r.found]) for r in few] == [(4, [("b", 2)]), (0, []), (0, []), (1, [])]


def test_searches_store_no_postings(spark):
    """What hybrid and keyword searches write has a row for each visible chunk, with counts of the queries' terms alone and no texts."""
    seen = retrieval.seen_chunks(spark, DATA)
    assert seen.count() == seen.select("chunk_set_id", "chunk_id").distinct().count()
    assert set(seen.columns) == {"chunk_set_id", "chunk_id", "length", "found", "tenant_id", "knowledge_base_id"}
    asked = {r.term for r in keyword.query_terms(retrieval.keyword_queries(spark, DATA)).collect()}
    assert {r.term for r in seen.select(F.explode("found.term").alias("term")).distinct().collect()} <= asked


def vectors_of(spark, n, seed):
    rng = np.random.default_rng(seed)
    made = [rng.integers(-2, 3, 4).astype("float32").tolist() for _ in range(n)]  # few values: copies, ties and zero vectors
    made += [[float("nan")] * 4, [float("inf")] + [1.0] * 3, [1.0] * 3, None, [None, 1.0, 1.0, 1.0]]
    rows = [(f"s{i % 7}", f"c{i:05}", ("m", "o", None)[min(2, i % 11)] if i % 11 < 3 else "m", v) for i, v in enumerate(made)]
    return spark.createDataFrame(rows, "chunk_set_id string, chunk_id string, model_key string, embedding array<float>")


def test_many_queries_by_products(spark, monkeypatch):
    """Batch and index searches rank as the functions do, by products of matrices: no join makes a row for each pair."""
    rows = vectors_of(spark, 900, 1)
    asked = vectors_of(spark, 60, 2).filter("not exists(embedding, x -> isnan(x) or abs(x) > 9)").select(F.col("chunk_id").alias("query_id"), F.coalesce("model_key", F.lit("m")).alias("model_key"), F.col("embedding").alias("vector"))
    finite = rows.filter("not coalesce(exists(embedding, x -> isnan(x) or abs(x) > 9), false)")
    expected = sorted(search.search_many(asked, finite, None).filter("rank <= 6").collect())
    for size in (blocks.PRODUCT_BYTES, 3_000):
        monkeypatch.setattr(blocks, "PRODUCT_BYTES", size)
        found = search.search_many(asked, rows.repartition(3), 6)
        assert sorted(found.collect()) == expected
    assert "Join" not in plan_of(found)
    index = ann.VectorIndex.build(rows.withColumn("searchable", F.lit(True)), scratch(spark, "test-products"), ann.IndexConfig(4, lists=5))
    sets = spark.createDataFrame([(f"s{i}", "t", "kb", "d", "u", "n", "active") for i in range(7)], "id string, tenant_id string, knowledge_base_id string, document_id string, source_uri string, source_name string, status string")
    four = asked.filter("size(vector) = 4")
    expected = sorted(search.search_many(four, finite.filter("size(embedding) = 4"), None).filter("rank <= 6").collect())
    assert sorted(index.search_many(four, sets, 6, index.lists).collect()) == expected
    near = {(r.query_id, r.list) for r in ann.probed(four, index.centroids, 2).collect()}
    pairs = search.search_many(four, index.vectors, None).join(index.vectors.select("chunk_set_id", "chunk_id", "list"), ["chunk_set_id", "chunk_id"])
    by_query = {}
    for r in sorted(pairs.collect(), key=lambda r: (r.query_id, r["rank"])):
        if (r.query_id, r.list) in near:
            by_query.setdefault(r.query_id, []).append((r.chunk_set_id, r.chunk_id))
    got = {}
    for r in index.search_many(four, sets, 6, 2).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.chunk_set_id, r.chunk_id))
    assert got == {q: found[:6] for q, found in by_query.items()}


def test_pages_come_in_bounded_batches(spark):
    """A worker gets at most BATCH_BYTES of pages at once, whatever the session's setting was; results are whole."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "256m")
    found = queries.page_sections(spark, DATA)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(shared.BATCH_BYTES)
    assert "ArrowEvalPython" not in plan_of(found)
    pages = queries.read(spark, DATA, "pages").collect()
    assert found.select("document_id").distinct().count() == sum(bool(U.parse_html(p.html or "")) for p in pages)


def test_upserts_read_either_side_once(spark):
    """Stored rows and new ones meet in one full join; rows of null keys, and repeated ones, stay."""
    rows = lambda *found: spark.createDataFrame(found, "k string, x string, created long")
    stored = rows(("a", "old", 1), ("b", None, None), (None, "n", 1), ("d", "d", 1), ("d", "d", 2))
    new = rows(("a", None, 2), ("b", "B", 2), ("c", "C", 2), (None, "N", 2), ("d", "D", 3))
    found = reconcile.upserted(stored, new, ["k"], ["created"])
    expected = [("a", None, 1), ("b", "B", 2), ("c", "C", 2), (None, "N", 2), (None, "n", 1), ("d", "D", 1), ("d", "D", 2)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_input_targets_read_either_side_once(spark):
    """Chunks and inputs meet in one count by id; repeated rows stay, null ids have no counterpart."""
    rows = lambda *ids: spark.createDataFrame([("s", i, "child") for i in ids], "chunk_set_id string, chunk_id string, kind string")
    found = rules.input_targets(rows("a", "b", "b", "c", "c", None), rows("a", "a", "b", "d", "d", None), chunking.PARENT_CHILD)
    expected = [("c", "missing"), ("c", "missing"), (None, "missing"), ("d", "unexpected"), ("d", "unexpected"), (None, "unexpected")]
    assert sorted(map(str, ((r.chunk_id, r.problem) for r in found.collect()))) == sorted(map(str, expected))
    assert "Join" not in plan_of(found)


def test_saved_rows_are_moved_once(spark):
    """Chunks are dealt to their buckets and meet the saved sets there; rows of no set go, an old scope is replaced."""
    from orrery.plans.layout import Layout

    layout = Layout(spark, "growth_layout", scratch(spark, "growth-layout"), 4)
    sets = spark.createDataFrame([(f"s{i}", f"t{i % 2}", "k") for i in range(6)], "id string, tenant_id string, knowledge_base_id string")
    chunks = spark.createDataFrame([(f"s{i % 8}", f"c{i}", i, "other") for i in range(40)], "chunk_set_id string, chunk_id string, sequence int, tenant_id string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layout.save(sets, chunks, chunks.select("chunk_set_id", "chunk_id"))
        made = layout._scoped(chunks)
        assert plan_of(made).count("Exchange") == 1 and "SortMergeJoin" in plan_of(made)
        expected = sorted((f"s{i % 8}", f"c{i}", f"t{i % 8 % 2}") for i in range(40) if i % 8 < 6)
        for name in ("chunks", "chunk_embeddings"):
            assert sorted(layout.table(name).select("chunk_set_id", "chunk_id", "tenant_id").collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        layout.drop()

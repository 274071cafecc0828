import hashlib
import http.server
import json
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from orrery.__main__ import LOCAL_MODEL, arguments, embedding
from orrery.errors import BuildConflict, EmbeddingUnavailable, EngineError, InvalidBuild, InvalidConfig, InvalidDependencies, InvalidEmbedding, InvalidEvidence, InvalidRequest, OversizeBlock, StoreUnavailable
from orrery.functions import canonical, exprs
from orrery.operators import chunking, embedder, rules, search
from orrery.operators.mapping import BuildSpec, ModelProfile, map_build
from orrery.plans import config
from orrery.plans.runtime import Descriptor, Runner
from orrery.plans.store import IndexStore
from orrery.plans.workflows import IndexingWorkflow, IndexRequest, Query, RetrievalWorkflow
from orrery.sources import schemas, units

MODEL = ModelProfile(dimensions=8)


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def test_model_key_golden(spark):
    key = exprs.model_key(F.lit(" text-embedding-v4"), F.lit(1536), F.lit("cosine "), F.lit("model-v1"))
    assert one(spark, key) == "text-embedding-v4:b9fb56c67146c5f8f5a6d46db6e828d3a6ef9f00a4d835bcd6c4910cd8478005"


def test_lock_key_has_lengths():
    assert exprs.lock_key("tenant", "kb", "d", "s") != exprs.lock_key("tenantk", "b", "d", "s")
    assert -(1 << 63) <= exprs.lock_key("a", "b", "c", "d") < 1 << 63


def test_trim_takes_unicode_white_space_alone(spark):
    assert one(spark, exprs.trim(F.lit("\u3000\u0085 a\u200b \u2028"))) == "a\u200b"


@pytest.mark.parametrize(("uri", "bad"), [("https://example.com/a", False), ("knowledge://local/x", False), ("/etc/a", True), ("C:\\a", True), ("a/b", True), ("https://u:p@e.com/", True), ("https://e.com/?q", True), ("https://e.com/#f", True), ("file:///a", True), ("https:///a", True), ("", True), (None, True)])
def test_source_uris(spark, uri, bad):
    assert one(spark, exprs.bad_uri(F.lit(uri).cast("string"))) is bad


def test_distance_of_odd_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert one(spark, exprs.cosine_distance(v(1, 0), v(-1, 0))) == 2.0
    assert one(spark, exprs.cosine_distance(v(0, 0), v(1, 0))) is None
    assert one(spark, exprs.cosine_distance(v(1, 0), v(1, 0, 0))) is None
    assert one(spark, exprs.finite(v(1, float("nan")))) is False
    assert one(spark, exprs.finite(v(1, 3.5e38))) is False


def test_embedding_texts(spark):
    text = lambda mode, path: one(spark, exprs.embedding_text_structure(F.lit(mode), path, F.lit("body")))
    assert text(" prepend ", F.array(F.lit("a"))) == "body"
    assert text("metadata_only", F.array(F.lit(" a "), F.lit("b"))) == "a > b\n\nbody"
    assert text("metadata_only", F.lit(None).cast("array<string>")) == "body"


@pytest.mark.parametrize("text", ["[1]", "null", '{"a":1}x', '{"a":NaN}', "", None, "1"])
def test_only_objects_are_objects(text):
    assert canonical.parse_object(text) is None


def test_metadata_keys_are_stripped(spark):
    df = spark.createDataFrame([('{"source_uri":"x","nested":{"key":"value","a":[1.0]}}',)], "m string")
    assert df.select(canonical.without_set_keys(F.col("m"))).first()[0] == '{"nested":{"a":[1.0],"key":"value"}}'


def as_units(spark, text, structured=True):
    parser = units.parse_markdown if structured else units.parse_text
    made = [("d", i, c, structured, p, "v") for i, (c, p) in enumerate(parser(text))]
    return units.prepared(spark.createDataFrame(made, units.UNITS + ", content_sha256 string"))


def test_sections_are_not_merged(spark):
    found = chunking.structure_aware(as_units(spark, "# A\n\np\n\n## B\n\nq")).orderBy("sequence").collect()
    assert [r.content for r in found] == ["A\n\np", "A > B\n\nq"]
    assert found[0].next_chunk_id == found[1].chunk_id and found[1].previous_chunk_id == found[0].chunk_id


def test_fenced_block_is_its_own_chunk(spark):
    found = chunking.structure_aware(as_units(spark, "# A\n\np\n\n```sh\nls\n```\n")).orderBy("sequence").collect()
    assert [r.content for r in found] == ["A\n\np", "A\n\n```sh\nls\n```"]


def test_oversize_block(spark):
    with pytest.raises(Exception, match="OversizeBlock"):
        chunking.structure_aware(as_units(spark, "# A\n\n```\n" + "x" * 1801 + "\n```")).collect()
    assert issubclass(OversizeBlock, InvalidBuild)


def test_headings_count_and_sections_reach_their_least(spark):
    limits = chunking.ChunkConfig(structure_max=100, structure_min=40)
    text = "# Heading\n\n" + "\n\n".join("word " * 5 + f"n{i}" for i in range(9)) + "\n\n## Other\n\n" + "x" * 350 + "\n"
    found = chunking.structure_aware(as_units(spark, text), limits).orderBy("sequence").collect()
    assert all(r.character_count <= 100 and r.character_count == len(r.content) for r in found)
    assert {r.content.split("\n\n")[0] for r in found} == {"Heading", "Heading > Other"}
    assert "".join(r.content.removeprefix("Heading > Other\n\n") for r in found if "Other" in r.content) == "x" * 350


def test_last_run_of_a_section_takes_from_the_one_before():
    texts = [(str(i), "a" * n) for i, n in enumerate((30, 30, 30, 10))]
    assert [[len(x) for _, x in run] for run in chunking.section_chunks(texts, 94, 25)] == [[30, 30], [30, 10]]
    assert [[len(x) for _, x in run] for run in chunking.section_chunks(texts, 94, 70)] == [[30, 30, 30], [10]]
    assert chunking.section_chunks([], 94, 25) == []


def test_headings_that_leave_no_room_stay_in_the_metadata():
    limits = chunking.ChunkConfig(structure_max=100, structure_min=40)
    assert chunking.structured([("u", "body", ["h" * 60])], limits) == [("body", ["h" * 60], ["u"], True)]
    assert chunking.structured([("u", "```\n" + "x" * 88 + "\n```", ["head"])], limits) == [("```\n" + "x" * 88 + "\n```", ["head"], ["u"], True)]


def test_windows_drop_blank_ones_and_link_the_rest(spark):
    found = chunking.parent_child(as_units(spark, "a" * 500 + " " * 500 + "b" * 1500, False)).orderBy("sequence").collect()
    assert [(r.kind, r.character_count) for r in found] == [("parent", 2000), ("child", 500), ("child", 500), ("child", 500), ("parent", 500), ("child", 500)]
    assert found[1].next_chunk_id == found[2].chunk_id and found[1].previous_chunk_id is None and found[3].next_chunk_id is None


@pytest.mark.parametrize("wrong", [{"profile_name": " "}, {"child_max": 0}, {"child_max": 3000}, {"structure_min": 2000}, {"heading_context": "x"}])
def test_chunk_config(wrong):
    with pytest.raises(InvalidConfig):
        chunking.ChunkConfig(**wrong)


def a_build(spark, text="one two three. " * 60, set_id=None, document="doc-1", config_=chunking.ChunkConfig()):
    made = chunking.parent_child(as_units(spark, text, False).withColumn("document_id", F.lit(document)), config_)
    spec = BuildSpec(set_id or str(uuid.uuid4()), "t", "k", document, "https://example.com/a", "a", "0" * 64, chunking.PARENT_CHILD, config_, MODEL)
    return map_build(spec, made), spec


@pytest.mark.parametrize(("rule", "column", "value"), [
    ("R-CH5", "character_count", "1"), ("R-CH6", "source_unit_ids", "array(' ')"), ("R-CH9", "metadata", "'[]'"), ("R-KIND", "level", "3"),
    ("R-CH3", "sequence", "1"), ("R-CH7", "document_id", "'other'"), ("R-CH8", "chunk_set_id", "'other'"), ("R-PC2", "parent_chunk_id", "if(kind = 'child', 'x', null)"), ("R-ADJ", "next_chunk_id", "cast(null as string)"), ("R-CH10", "previous_chunk_id", "chunk_id"),
])
def test_each_rule_sees_its_mutation(spark, rule, column, value):
    build, spec = a_build(spark)
    rules.validate_build(build, spec.strategy_name)
    from dataclasses import replace

    with pytest.raises(InvalidBuild, match=rule):
        rules.validate_build(replace(build, chunks=build.chunks.withColumn(column, F.expr(value))), spec.strategy_name)


def test_rules_of_the_set_and_of_paths(spark):
    from dataclasses import replace

    build, spec = a_build(spark)
    for column, value, rule in (("config", "'{\"a\":1}'", "R-CFG2"), ("strategy_name", "' parent_child'", "R-SPEC"), ("content_sha256", "'x'", "R-SHA")):
        with pytest.raises(InvalidBuild, match=rule):
            rules.validate_build(replace(build, sets=build.sets.withColumn(column, F.expr(value))), spec.strategy_name)
    with pytest.raises(InvalidBuild, match="R-PROF"):
        map_build(spec, build.chunks, ("rag-document-indexing", "v1"))
    config_ = chunking.ChunkConfig(heading_context="metadata_only")
    made = chunking.structure_aware(as_units(spark, "# A\n\nbody").withColumn("document_id", F.lit("doc-1")), config_)
    spec = replace(spec, strategy_name=chunking.STRUCTURE_AWARE, config=config_)
    build = map_build(spec, made)
    rules.validate_build(build, spec.strategy_name)
    assert build.inputs.first().embedding_text == "A\n\nbody"
    with pytest.raises(InvalidBuild, match="R-PATH"):
        rules.validate_build(map_build(spec, made.withColumn("metadata", F.lit('{"semantic_path":["A",1]}'))), spec.strategy_name)


def test_version_is_that_of_the_bytes(spark, tmp_path):
    hashes = []
    for text in ("# Alpha\n\nbody", "# Beta\n\nbody"):
        (tmp_path / "a.md").write_text(text)
        found = units.read_files(spark, f"file://{tmp_path}/a.md").first()
        assert found.content_sha256 == hashlib.sha256(text.encode()).hexdigest() and found.mime_type == "text/markdown" and found.content == "body"
        hashes.append(found.content_sha256)
    assert hashes[0] != hashes[1]


class Service(http.server.BaseHTTPRequestHandler):
    """An embedding service: the vector of a text is its length; some texts make it fail."""

    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        text = body["input"][0]
        self.seen.append((self.path, self.headers["Authorization"], body))
        answer = {"data": [{"embedding": [float(len(text))] * body["dimensions"]}], "usage": {"prompt_tokens": len(text.split())}}
        if text == "short":
            answer["data"][0]["embedding"].pop()
        elif text == "unmetered":
            answer.pop("usage")
        elif text == "two":
            answer["data"] *= 2
        content = b"not json" if text == "broken" else b" " * (embedder.RESPONSE_BYTES + 1) if text == "large" else json.dumps(answer).encode()
        if text == "slow":
            time.sleep(1.5)
        try:
            self.send_response(500 if text == "fail" else 200)
            self.end_headers()
            self.wfile.write(b"secret reason" if text == "fail" else content)
        except OSError:
            pass

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def service():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()


def test_embedding_client(spark, service):
    client = embedder.HttpEmbedder(service, config.Secret("key"), "m", 4, 1.0, 3)
    assert client.embed(["a", "b c", "déf g h"]) == [([1.0] * 4, 1), ([3.0] * 4, 2), ([7.0] * 4, 3)]
    path, key, body = Service.seen[0]
    assert path == "/v1/embeddings" and key == "Bearer key" and body["model"] == "m" and body["encoding_format"] == "float" and len(body["input"]) == 1
    for text in ("short", "unmetered", "two", "broken", "large"):
        with pytest.raises(InvalidEmbedding):
            client.embed(["a", text])
    for text in ("fail", "slow"):
        with pytest.raises(EmbeddingUnavailable) as e:
            client.embed([text])
        assert "secret" not in str(e.value) and "key" not in repr(client)
    for texts in ([], ["a", " "]):
        with pytest.raises(InvalidRequest):
            client.embed(texts)
    before = len(Service.seen)
    with pytest.raises(EmbeddingUnavailable):
        client.embed(["fail"] + ["a"] * 200)
    assert len(Service.seen) - before < 150
    with pytest.raises(InvalidConfig):
        embedder.HttpEmbedder(service, "", "m")
    with pytest.raises(EmbeddingUnavailable):
        embedder.HttpEmbedder("http://127.0.0.1:9", "k", "m", 4).embed(["a"])
    build, _ = a_build(spark)
    found = embedder.embed_inputs(build.inputs, client, 4).collect()
    assert len(found) == build.inputs.count() and all(r.embedding == [float(len(r.embedding_text))] * 4 and r.embedding_token_count == len(r.embedding_text.split()) for r in found)


def test_local_vectors_have_a_model_name_of_their_own(service):
    env = {"INDEX_ROOT": "/x"}
    model, made = embedding(config.load(env))
    assert isinstance(made, embedder.HashEmbedder) and model.model == LOCAL_MODEL
    model, made = embedding(config.load(env | {"EMBEDDING_BASE_URL": service, "EMBEDDING_KEY": "k", "EMBEDDING_TIMEOUT": "7s", "EMBEDDING_BATCH_SIZE": "4"}))
    assert isinstance(made, embedder.HttpEmbedder) and (model.model, made.timeout_s, made.concurrency) == ("text-embedding-v4", 7.0, 4)
    for half in ({"EMBEDDING_KEY": "k"}, {"EMBEDDING_BASE_URL": service}):
        with pytest.raises(InvalidConfig):
            embedding(config.load(env | half))


def records(pending):
    return embedder.embed_inputs(pending, embedder.HashEmbedder(8), 8)


def test_store_lifecycle(spark, tmp_path):
    store = IndexStore(spark, f"file://{tmp_path}", 8, buckets=2)
    build, spec = a_build(spark)
    pending = store.prepare_build(build, spec)
    n = pending.count()
    assert n > 1
    some = records(pending.orderBy("chunk_id").limit(1))
    store.save_embeddings(spec.set_id, some)
    assert store.prepare_build(build, spec).count() == n - 1
    with pytest.raises(InvalidBuild, match="R-IN1"):
        store.publish(spec.set_id)
    store.save_embeddings(spec.set_id, records(store.prepare_build(build, spec)))
    assert store.validate(spec.set_id) == n
    store.publish(spec.set_id)
    with pytest.raises(BuildConflict):
        store.publish(spec.set_id)
    second, spec2 = a_build(spark, "four five six. " * 60)
    store.save_embeddings(spec2.set_id, records(store.prepare_build(second, spec2)))
    store.publish(spec2.set_id)
    sets, _, vectors = store.frames()
    assert {r.id: r.status for r in sets.collect()} == {spec.set_id: "retired", spec2.set_id: "active"}
    assert {r.chunk_set_id for r in vectors.filter("searchable").collect()} == {spec2.set_id}
    store.validate_schema()
    store.delete(spec.set_id)
    before = store.frames()[2].count()
    store.vacuum()
    assert store.frames()[2].filter("searchable").count() == before > 0


def test_profile_with_another_config_is_a_conflict(spark, tmp_path):
    store = IndexStore(spark, f"file://{tmp_path}", 8, buckets=2)
    for config_, document in ((chunking.ChunkConfig(), "a"), (chunking.ChunkConfig(child_max=400), "b")):
        build, spec = a_build(spark, document=document, config_=config_)
        store.save_embeddings(spec.set_id, records(store.prepare_build(build, spec)))
    with pytest.raises(BuildConflict, match="R-PUB2"):
        store.publish(spec.set_id)


def test_both_of_two_publishers_succeed(spark, tmp_path):
    store = IndexStore(spark, f"file://{tmp_path}", 8, buckets=1)
    ids = []
    for text in ("one two. " * 60, "three four. " * 60):
        build, spec = a_build(spark, text)
        store.save_embeddings(spec.set_id, records(store.prepare_build(build, spec)))
        ids.append(spec.set_id)
    failed = []

    def publish(i):
        try:
            store.publish(i)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=publish, args=(i,)) for i in ids]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    assert sorted(r.status for r in store.frames()[0].collect()) == ["active", "retired"]


def test_workflows_end_to_end(spark, tmp_path):
    (tmp_path / "a.md").write_text("# Chunks\n\nStructured texts go by headings.\n\n## Vectors\n\nNear vectors come first.\n")
    store, seen = IndexStore(spark, f"file://{tmp_path}/index", 64), []
    model, hashes = ModelProfile(dimensions=64), embedder.HashEmbedder(64)
    flow = IndexingWorkflow(spark, store, hashes, model=model, observers=[lambda run, stage, event, s, e: seen.append((stage, event))])
    result = flow.run(IndexRequest("run-1", f"file://{tmp_path}/a.md", str(uuid.uuid4()), "t", "k", "doc", "knowledge://local/doc", "a.md"))
    assert result["published"] and result["chunk_count"] == 2 and ("publish_index", "succeeded") in seen
    search_flow = RetrievalWorkflow(spark, store, hashes, model)
    found = search_flow.run(Query(" q-1 ", "near vectors", "t", "k", 2))
    assert "Near vectors" in found["evidence"][0]["content"]
    assert search_flow.run(Query("q-2", "x", "t", "elsewhere"))["evidence"] == []
    for wrong in ("x" * 4097, "\ud800", " "):
        with pytest.raises(InvalidRequest):
            search_flow.run(Query("q", wrong, "t", "k"))


def test_runner_errors(spark):
    def fail(_):
        raise RuntimeError("secret")

    with pytest.raises(StoreUnavailable) as e:
        Runner(spark, Descriptor("a", "v1"), [("s", fail)]).run("r", None)
    assert "secret" not in str(e.value) and isinstance(e.value.__cause__, RuntimeError)
    with pytest.raises(InvalidDependencies):
        Descriptor(" ", "v1")
    with pytest.raises(InvalidRequest):
        Runner(spark, Descriptor("a", "v1"), [("s", fail)]).run(" ", None)
    assert issubclass(StoreUnavailable, EngineError)


def test_evidence_rules():
    good = dict(chunk_set_id="s", chunk_id="c", document_id="d", source_uri="u", source_name="n", kind="child", content="x", sequence=1, token_count=0, source_unit_ids=["u"], metadata="{}", cosine_distance=0.5)
    search.validate_evidence([good], 1)
    odd = [{"cosine_distance": 2.5}, {"cosine_distance": float("nan")}, {"metadata": "[]"}, {"metadata": "{"}, {"metadata": None}, {"sequence": 0}, {"document_id": None}, {"source_uri": None}, {"source_unit_ids": ["u", " "]}, {"source_unit_ids": []}, {"chunk_id": " c"}, {"content": "\n"}, {"token_count": -1}]
    for wrong in ([good, good], *([good | x] for x in odd)):
        with pytest.raises(InvalidEvidence):
            search.validate_evidence(wrong, 2)
    with pytest.raises(InvalidEvidence):
        search.validate_evidence([good], 0)
    with pytest.raises(InvalidRequest):
        search.SearchRequest("t", "k", "m", [float("nan")] * 8, 1, 8)
    with pytest.raises(InvalidEmbedding):
        embedder.checked([([1.0], 0)], 1, 1)


def test_schema_drift():
    from pyspark.sql import types as T

    assert schemas.drift(dict(schemas.TABLES)) == []
    changed = dict(schemas.TABLES)
    del changed["chunks"]
    changed["chunk_embeddings"] = T.StructType([f for f in schemas.EMBEDDINGS.fields if f.name != "embedding"])
    assert [(d.table, d.column) for d in schemas.drift(changed)] == [("chunk_embeddings", "embedding"), ("chunks", "")]


def test_nullability_drifts_and_names_are_identifiers():
    from pyspark.sql import types as T

    changed = dict(schemas.TABLES)
    changed["chunks"] = T.StructType([T.StructField(f.name, f.dataType, f.nullable or f.name == "content") for f in schemas.CHUNKS.fields])
    assert [(d.table, d.column, d.problem) for d in schemas.drift(changed)] == [("chunks", "content", "may be null")]
    assert schemas.drift(changed, nullability=False) == []
    assert schemas.qualified(" idx_1 ", "chunks") == "`idx_1`.`chunks`"
    for wrong in ("", "1a", "a b", "a;drop", "a`b", "é"):
        with pytest.raises(InvalidConfig):
            schemas.qualified(wrong, "chunks")


def test_settings():
    found = config.load({"INDEX_ROOT": "/x", "EMBEDDING_KEY": "abc", "EMBEDDING_BASE_URL": "https://e.com/v1//"})
    assert "abc" not in repr(found) and found.embedding_key.reveal() == "abc" and found.embedding_base_url == "https://e.com/v1" and found.batch == 10
    for wrong in ({}, {"INDEX_ROOT": "/x", "EMBEDDING_BATCH_SIZE": "11"}, {"INDEX_ROOT": "/x", "EMBEDDING_BASE_URL": "https://u:p@e.com"}, {"INDEX_ROOT": "/x", "EMBEDDING_TIMEOUT": "-1s"}):
        with pytest.raises(InvalidConfig):
            config.load(wrong)


def test_arguments():
    assert arguments([]) == ("strategy", 3) and arguments([" q ", "20"]) == ("q", 20)
    for wrong in (["a", "0"], ["a", "21"], ["a", "x"], [""], ["a", "1", "b"]):
        with pytest.raises(InvalidRequest):
            arguments(wrong)

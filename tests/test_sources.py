"""Sources by HTTP, Word and Excel documents, the embedding client's bounds, headings and the tables' layout."""

import http.server
import io
import json
import threading
import time
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.errors import BuildConflict, EmbeddingUnavailable, EngineError, InvalidBuild, InvalidRequest, SourceUnavailable
from orrery.functions import canonical
from orrery.functions import exprs as X
from orrery.operators import chunking, embedder, rules, search
from orrery.plans.layout import Layout
from orrery.sources import office, schemas, units, web
from orrery.sources.shared import scratch

# ---- a server


class Site(http.server.BaseHTTPRequestHandler):
    hits: Counter = Counter()
    under_way = most = 0
    lock = threading.Lock()
    posts: list = []

    def do_GET(self):
        self.hits[self.path] += 1
        if self.path.startswith("/to/"):
            self.send_response(302)
            self.send_header("Location", {"page": "/pages/a.html", "query": "/pages/a.html?x=1", "loop": "/to/loop", "user": "http://u:p@127.0.0.1/", "file": "file:///etc/passwd"}[self.path[4:]])
            self.end_headers()
            return
        body = {"/pages/a.html": b"<h1>Top</h1><p>first</p><p>second</p>", "/b.md": b"# One\n\ntext", "/plain": "größe".encode(), "/large": b"x" * 5_000}.get(self.path)
        if self.path == "/drip":
            self.send_response(200)
            self.end_headers()
            try:
                for _ in range(40):
                    self.wfile.write(b"x")
                    self.wfile.flush()
                    time.sleep(0.2)
            except OSError:
                pass
            return
        self.send_response(200 if body is not None else 404)
        self.send_header("Content-Type", "text/plain; charset=utf-8" if self.path == "/plain" else "text/html")
        self.end_headers()
        self.wfile.write(body or b"")

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        text = body["input"][0]
        with self.lock:
            Site.under_way += 1
            Site.most = max(Site.most, Site.under_way)
            self.posts.append((self.path, text))
        time.sleep(0.03)
        with self.lock:
            Site.under_way -= 1
        if self.path.startswith("/moved"):
            self.send_response(302)
            self.send_header("Location", "/v1/embeddings")
            self.end_headers()
            return
        self.send_response(500 if text == "fail" else 200)
        self.end_headers()
        content = json.dumps({"data": [{"embedding": [1.0, float(len(text))]}], "usage": {"prompt_tokens": 1}}).encode()
        try:
            if text == "drip":
                for i in range(len(content)):
                    self.wfile.write(content[i : i + 1])
                    self.wfile.flush()
                    time.sleep(0.1)
            else:
                self.wfile.write(content)
        except OSError:
            pass

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def site():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_documents_by_http(spark, site):
    found = units.read_web(spark, [f"{site}/pages/a.html", f"{site}/b.md", f"{site}/plain", f"{site}/to/page"], each=2).orderBy("uri", "position").collect()
    got = [(r.uri.removeprefix(site), r.content, r.path, r.structured, r.mime_type) for r in found]
    assert got == [
        ("/b.md", "text", ["One"], True, "text/markdown"), ("/pages/a.html", "first", ["Top"], True, "text/html"), ("/pages/a.html", "second", ["Top"], True, "text/html"),
        ("/plain", "größe", [], False, "text/plain"), ("/to/page", "first", ["Top"], True, "text/html"), ("/to/page", "second", ["Top"], True, "text/html"),
    ]
    assert [r.content for r in units.read_source(spark, f"{site}/b.md").collect()] == ["text"]
    df = spark.read.format("web_documents").option("addresses", json.dumps([f"{site}/plain"] * 5)).option("each", "2").load()
    assert df.rdd.getNumPartitions() == 3 and df.count() == 5
    assert spark.read.format("web_documents").option("addresses", "[]").load().count() == 0


def test_addresses_keep_the_policy(spark, site):
    for bad in ("ftp://a/b", "http:///x", "http://u:p@a/", "http://a/?q", "http://a/#f", "http://a/b c", "relative", "http://a:99999/", "file:///etc/passwd", "http://a/\r\nX: y"):
        assert not web.allowed(bad)
        with pytest.raises(InvalidRequest):
            web.fetched(bad)
    for path in ("/to/query", "/to/user", "/to/file"):
        with pytest.raises(InvalidRequest):
            web.fetched(site + path)
    with pytest.raises(SourceUnavailable):
        web.fetched(f"{site}/to/loop", redirects=3)
    assert Site.hits["/to/loop"] == 4
    with pytest.raises(InvalidRequest):
        web.fetched(f"{site}/large", most=4_999)
    assert len(web.fetched(f"{site}/large", most=5_000)[3]) == 5_000
    for path in ("/none", "/drip"):
        began = time.time()
        with pytest.raises(SourceUnavailable):
            web.fetched(site + path, seconds=1.0)
        assert time.time() - began < 4
    with pytest.raises(SourceUnavailable):
        web.fetched("http://127.0.0.1:9/")
    with pytest.raises(Exception, match="policy"):
        units.read_web(spark, ["http://a/?q=1"]).count()


# ---- the embedding client


def inputs(spark, texts, parts=5):
    rows = [("s", f"c{i}", "m", t, "h") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "chunk_set_id string, chunk_id string, model_key string, embedding_text string, input_sha256 string").repartition(parts)


def test_requests_of_a_run_are_bounded(spark, site):
    for limit, tasks in ((6, 2), (10, 3), (2, 4)):
        Site.most = 0
        client = embedder.HttpEmbedder(f"{site}/v1", "key", "m", 2, 10.0, limit)
        found = embedder.embed_inputs(inputs(spark, [f"text {i}" for i in range(60)]), client, 2, tasks=tasks).collect()
        assert len(found) == 60 and all(r.embedding == [1.0, float(len(r.embedding_text))] for r in found)
        assert 1 <= Site.most <= limit
    before = len(Site.posts)
    with pytest.raises(Exception, match="status 500"):
        embedder.embed_inputs(inputs(spark, ["fail"] * 300, 1), client, 2).collect()
    assert len(Site.posts) - before < 100


def test_the_key_stays_with_its_host(site):
    with pytest.raises(EmbeddingUnavailable, match="302"):
        embedder.HttpEmbedder(f"{site}/moved", "key", "m", 2).embed(["a"])
    assert Site.posts[-1] == ("/moved/embeddings", "a")


def test_the_time_of_a_whole_request_is_bounded(site):
    began = time.time()
    with pytest.raises(EmbeddingUnavailable):
        embedder.HttpEmbedder(f"{site}/v1", "key", "m", 2, 1.0).embed(["drip"])
    assert time.time() - began < 4


# ---- Word and Excel


def zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
EXCEL = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def paragraph(text, style=None, extra=""):
    properties = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
    return f"<w:p>{properties}<w:r><w:t>{text}</w:t>{extra}</w:r></w:p>"


def docx(body):
    styles = f'<w:styles {WORD}><w:style w:styleId="berschrift1"><w:name w:val="heading 1"/></w:style><w:style w:styleId="H2"><w:name w:val="Custom"/><w:pPr><w:outlineLvl w:val="1"/></w:pPr></w:style><w:style w:styleId="Mine"><w:name w:val="Mine"/><w:basedOn w:val="berschrift1"/></w:style><w:style w:styleId="A"><w:basedOn w:val="B"/></w:style><w:style w:styleId="B"><w:basedOn w:val="A"/></w:style></w:styles>'
    return zipped({"word/document.xml": f"<w:document {WORD}><w:body>{body}</w:body></w:document>", "word/styles.xml": styles})


def test_word_documents():
    cell = lambda t: f"<w:tc>{paragraph(t)}</w:tc>"
    body = paragraph("before") + paragraph("One", "berschrift1") + paragraph("a &amp; b", "A", "<w:tab/><w:t>c</w:t><w:br/><w:t>d</w:t>") + paragraph("Two", "H2") + paragraph("  ")
    body += f"<w:tbl><w:tr>{cell('x')}{cell('y')}</w:tr><w:tr>{cell('')}{cell(' ')}</w:tr></w:tbl>" + paragraph("Three", "Mine") + "<w:sdt><w:sdtContent>" + paragraph("deep") + "</w:sdtContent></w:sdt>"
    body += '<w:p><w:r><w:delText>gone</w:delText></w:r></w:p><w:p><w:pPr><w:outlineLvl w:val="2"/></w:pPr><w:r><w:t>Fine</w:t></w:r></w:p>' + paragraph("end")
    assert office.parse_docx(docx(body)) == [("before", []), ("a & b\tc\nd", ["One"]), ("x\ty", ["One", "Two"]), ("deep", ["Three"]), ("end", ["Three", "Fine"])]
    assert office.parse_docx(docx("")) == []


def xlsx():
    sheet = lambda rows: f"<worksheet {EXCEL}><sheetData>{rows}</sheetData></worksheet>"
    first = '<row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>1.5</v></c><c r="B2" t="b"><v>1</v></c><c r="C2" t="inlineStr"><is><t>in</t></is></c><c r="D2" t="s"><v>9</v></c></row><row><c r="A3"/></row>'
    return zipped({
        "xl/workbook.xml": f'<workbook {EXCEL}><sheets><sheet name="Second" r:id="r2"/><sheet name=" First " r:id="r1"/><sheet name="None" r:id="r9"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {EXCEL}><si><t>name</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>",
        "xl/worksheets/sheet1.xml": sheet(first), "xl/worksheets/sheet2.xml": sheet('<row><c t="str"><v>f</v></c></row>'),
    })


def test_excel_workbooks():
    assert office.parse_xlsx(xlsx()) == [("f", ["Second"]), ("name\t\trich", ["First"]), ("1.5\tTRUE\tin", ["First"])]


def test_broken_office_documents():
    for parser in (office.parse_docx, office.parse_xlsx):
        for content in (b"no zip", zipped({"other": "x"})):
            with pytest.raises(ValueError):
                parser(content)
    with pytest.raises(ValueError, match="entities"):
        office.parse_docx(zipped({"word/document.xml": f'<!DOCTYPE x [<!ENTITY a "b">]><w:document {WORD}/>'}))


def test_files_of_all_kinds(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx(paragraph("One", "berschrift1") + paragraph("body")))
    (tmp_path / "b.XLSX").write_bytes(xlsx())
    (tmp_path / "c.html").write_text("<h1>H</h1><p>p</p>")
    found = units.read_files(spark, f"file://{tmp_path}").collect()
    assert sorted((r.uri[-6:], r.content, r.path[0]) for r in found) == [("a.docx", "body", "One"), ("b.XLSX", "1.5\tTRUE\tin", "First"), ("b.XLSX", "f", "Second"), ("b.XLSX", "name\t\trich", "First"), ("c.html", "p", "H")]
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    with pytest.raises(Exception, match="no parser for .pdf"):
        units.read_files(spark, f"file://{tmp_path}").count()


# ---- headings, order


def test_long_headings_are_embedded(spark):
    config = chunking.ChunkConfig(structure_max=100, structure_min=10)
    rows = [("d", "u1", 1, "body", ["h" * 60]), ("d", "u2", 2, "more", ["short"]), ("d", "u3", 3, "```\n" + "x" * 90 + "\n```", ["short"])]
    made = chunking.structure_aware(spark.createDataFrame(rows, "document_id string, unit_id string, unit_index int, content string, path array<string>"), config)
    text = X.embedding_text_structure(F.lit("prepend"), F.from_json(F.get_json_object("metadata", "$.semantic_path"), "array<string>"), F.col("content"), F.get_json_object("metadata", "$.headings_apart") == "true")
    got = [(r.content[:5], r.text.split("\n\n")[0]) for r in made.withColumn("text", text).orderBy("sequence").collect()]
    assert got == [("body", "h" * 60), ("short", "short"), ("```\nx", "short")]
    assert all(r.character_count <= 100 for r in made.collect())


def test_evidence_order_without_a_single_task(spark):
    rows = [(i, 0.1 * (i // 3), "s", f"c{i:04}") for i in range(300)]
    rows[40], rows[41] = (40, rows[41][1], "s", "c0041"), (41, rows[40][1], "s", "c0040")
    rows[200] = (200, *rows[199][1:])
    df = spark.createDataFrame(rows, "rank int, cosine_distance double, chunk_set_id string, chunk_id string").repartition(6)
    found = rules.evidence_order(df)
    assert sorted(r["rank"] for r in found.collect()) == [41, 200]
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    assert rules.evidence_order(df.filter("false")).collect() == []


TEXTS = ["{}", '{"a":1}', ' {"a":1} ', '{"a":1}x', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"a":NaN}', '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}', "[1]", "[{}]", "null", "7", '"x"', "", " ", '{"a":Infinity}', "{a:1}", "{'a':1}", '{"a":1,}', '{"a":01}', '{"a":"b\nc"}', '/*x*/{"a":1}', "{}]", "],[", "{}],[{}", '{},0]x', '{},"x"]', "{}:", '{"a":[1,{"b":null}]}', None]


def test_objects_are_told_in_the_jvm(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = df.select("i", canonical.is_object(F.col("t")).alias("is")).orderBy("i")
    assert [(TEXTS[r.i], r["is"]) for r in got.collect()] == [(t, canonical.parse_object(t) is not None) for t in TEXTS]
    chunks = df.select(F.lit("s").alias("chunk_set_id"), F.col("i").cast("string").alias("chunk_id"), F.col("t").alias("metadata"))
    for found in (rules.metadata_objects(chunks), rules.config_snapshots(df.select(F.lit("s").alias("id"), F.lit("parent_child").alias("strategy_name"), F.col("t").alias("config")))):
        assert "Python" not in plan(found) and "Arrow" not in plan(found)


# ---- the layout

SETS = "id string, tenant_id string, knowledge_base_id string, document_id string, source_uri string, source_name string, status string"


@pytest.fixture(scope="module")
def layout(spark):
    """Ten thousand sets in three scopes."""
    n = 10_000
    sets = spark.range(n).select(F.format_string("s%05d", "id").alias("sid"), "*").select(F.col("sid").alias("id"), F.lit("t").alias("tenant_id"), F.concat(F.lit("kb"), (F.col("id") % 3).cast("string")).alias("knowledge_base_id"), F.concat(F.lit("d"), "sid").alias("document_id"), F.lit("u").alias("source_uri"), F.lit("n").alias("source_name"), F.when(F.col("id") % 5 == 0, "retired").otherwise("active").alias("status"))
    sets = spark.createDataFrame(sets.collect(), SETS)
    chunks = sets.select(F.col("id").alias("chunk_set_id"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("sequence")).select("chunk_set_id", F.concat(F.lit("c"), F.col("sequence").cast("string")).alias("chunk_id"), F.lit("child").alias("kind"), "sequence", F.lit("x").alias("content"), F.lit(1).alias("token_count"), F.array(F.lit("u")).alias("source_unit_ids"), F.lit("{}").alias("metadata"))
    vectors = chunks.select("chunk_set_id", "chunk_id", F.lit("m").alias("model_key"), F.array(F.rand(3), F.rand(4), F.rand(5)).cast("array<float>").alias("embedding"), (F.col("sequence") == 1).alias("searchable"))
    found = Layout(spark, "layout_test", scratch(spark, "layout"), 4)
    found.save(sets, chunks, vectors)
    yield found
    found.drop()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordered_scans_and_joins_exchange_nothing(spark, layout):
    scan = layout.ordered()
    assert "Exchange" not in plan(scan) and scan.count() == 20_000
    assert [(r.place, r.before) for r in scan.filter("chunk_set_id = 's00007'").orderBy("place").collect()] == [(1, None), (2, "c1")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = layout.with_vectors()
        assert "Exchange" not in plan(both) and both.count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_scopes_are_folders_and_sets_are_not(spark, layout, tmp_path):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{layout.folder}/chunks")
    files = path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path)
    assert files.getDirectoryCount() <= 5 and files.getFileCount() <= 3 * 4 + 1 + 13
    request = search.SearchRequest("t", "kb1", "m", [0.1, 0.2, 0.3], 5, 3)
    found = layout.search(request)
    assert "knowledge_base_id" in plan(found).split("PartitionFilters")[1][:300]
    got = found.collect()
    assert len(got) == 5 and all(int(r.chunk_set_id[1:]) % 3 == 1 and int(r.chunk_set_id[1:]) % 5 and r.chunk_id == "c1" for r in got)
    seen = layout.visible()
    assert seen.count() == 8_000
    assert "dynamicpruning" in plan(layout.visible().filter("document_id = 'ds00007'")).lower()


def test_nulls_are_drift(spark, layout):
    df = spark.createDataFrame([], schemas.CHUNKS)
    assert schemas.nulls("chunks", df) == []
    loose = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType, True) for f in schemas.CHUNKS.fields])
    row = {f.name: None for f in loose.fields} | {"chunk_set_id": "s", "chunk_id": "c", "level": 0, "sequence": 1, "token_count": 1, "character_count": 1, "source_unit_ids": ["u"], "metadata": "{}", "kind": "child"}
    assert [(d.column, d.problem) for d in schemas.nulls("chunks", spark.createDataFrame([row], loose))] == [("content", "1 nulls"), ("created_at", "1 nulls")]
    assert {d.problem for d in layout.drift()} == {"missing column"}


def test_errors_are_the_engines(spark):
    for kind in (SourceUnavailable, BuildConflict, InvalidBuild):
        assert issubclass(kind, EngineError)

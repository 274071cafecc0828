from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from orrery import queries as engine
from orrery.operators import chunking
from orrery.sources import units

from .conftest import DATA, oracle_rows, rows


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert rows(engine.queries()[name](spark, DATA)) == oracle_rows(duck, engine.oracle_sql()[name])


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(engine.queries()) <= set(entry.queries())


def test_page_sections_stay_under_their_limit(spark):
    found = engine.page_sections(spark, DATA).toPandas()
    assert len(found) and found.character_count.max() <= 1800
    assert (found.groupby("document_id").sequence.min() == 1).all()


class Blocks(HTMLParser):
    """All blocks of a page with their headings, by the library's tokens."""

    def __init__(self, text):
        super().__init__(convert_charrefs=True)
        self.blocks, self.path, self.text, self.level, self.silent = [], [], "", 0, 0
        self.feed(text)
        self.close()
        self.end()

    def end(self):
        block = self.text.strip()
        if block and self.level:
            self.path = [p for p in self.path if p[0] < self.level] + [(self.level, plain(block))]
        elif block:
            self.blocks.append((plain(block), [t for _, t in self.path]))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style", "title")
        if tag in units.BLOCKS:
            self.end()
            self.level = int(tag[1]) if tag in units.HEADINGS else 0
        elif tag in ("br", "td", "th"):
            self.text += " "

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style", "title")
        if tag in units.BLOCKS:
            self.end()
            self.level = 0

    def handle_data(self, data):
        if not self.silent:
            self.text += data


def plain(text):
    return " ".join(text.split())


def test_blocks_of_pages_are_whole_texts(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    tagged = 0
    for page in pages:
        got, want = units.parse_html(page.html), Blocks(page.html)
        assert [(plain(c), path) for c, path in got] == want.blocks
        tagged += "<li><a" in page.html
    assert tagged > 10
    # Chunks hold all of it: each block is a unit of some chunk.
    found = engine.page_sections(spark, DATA).toPandas().groupby("document_id")
    for page in pages:
        blocks = units.parse_html(page.html)
        if blocks:
            chunks = found.get_group(f"page-{page.page_id}")
            assert chunks.units.sum() >= len(blocks) and chunks.character_count.sum() >= sum(len(c) for c, _ in blocks)


def test_blocks_with_inner_tags_and_open_ends():
    def found(text):
        return [c for c, _ in units.parse_html(text)]

    assert units.parse_html("<h1>A <em>b</em></h1><ul><li><a href='/x>y'>one</a></li></ul><p><b>lead<br>next &amp; <i>on</i></p>") == [("one", ["A b"]), ("lead\nnext & on", ["A b"])]
    assert units.parse_html("<h1>x<h2>y<p>z<pre>code</pre><table><tr><td>cell<td>two</table><h2>w</h2>tail<h1>v</h1><dl><dd>d") == [("z", ["x", "y"]), ("code", ["x", "y"]), ("cell\ttwo", ["x", "y"]), ("tail", ["x", "w"]), ("d", ["v"])]
    assert found("<ul><li>two<ul><li>in</li></ul>tail</li></ul>") == ["two", "in", "tail"]
    assert found("<P>A<p class=x>B</article>after<p>a<div>b</div>c") == ["A", "B", "after", "a", "b", "c"]
    assert found('<title>t</title><p>a<!-- <p>c --> b<script>var t="</p><p>no";</script>d</p><style><p>no</style>') == ["a bd"]
    assert found("<p>1 < 2</p>") == ["1 < 2"] and found("") == found("<p> </p>") == []


def test_rows_of_documents_give_the_same_chunks(spark):
    """A document in one row and a document in a row for each unit are cut alike, links included."""
    config = engine.CONFIG
    rows = [(f"d{d}", [(f"u{d}-{i}", "word " * (40 * i + 30 * d), [f"h{i // 3}"] if i % 5 else None) for i in range(8)]) for d in range(4)] + [("none", [])]
    whole = spark.createDataFrame(rows, "document_id string, units array<struct<unit_id: string, content: string, path: array<string>>>")
    apart = whole.select("document_id", F.posexplode("units").alias("unit_index", "u")).select("document_id", "unit_index", "u.*")
    a, b = (sorted(map(tuple, df.collect())) for df in (chunking.structure_aware_rows(whole, config), chunking.structure_aware(apart, config)))
    assert a == b and len(a) > 8
    assert "Exchange" not in chunking.structure_aware_rows(whole, config)._jdf.queryExecution().executedPlan().toString()


def test_search_plan_filters_before_ranking(spark):
    plan = engine.vector_search_topk(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan

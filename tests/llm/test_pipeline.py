"""The pipeline's stages on a small table, each held against a plain version of its decision."""

import pytest

pytest.importorskip("public_tokenizers")

from orrery.llm import decontamination, pieces, quality
from orrery.llm.common import table, written

from ..conftest import DATA
from .test_operators import PIECES, brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_rows_that_share_or_lack_a_doc_id(spark):
    docs = table(spark, DATA, "documents")
    a, b = (r.text for r in docs.filter("n_chars BETWEEN 900 AND 3000 AND lang = 'en'").orderBy("doc_id").limit(2).collect())
    rows = [(None, a), (7, a), (7, a), (None, a), (None, b), (None, b), (8, ""), (8, b), (None, "123")]
    made = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], docs.schema)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.known_language(spark, made, DATA).collect()]
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in rows if r[1] not in ("", "123"))
    kept = corpus_pipeline.distinct(spark, made.filter("n_chars > 3"), DATA)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(7, a), (8, b)]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding and decoding"]
    docs = table(spark, DATA, "documents")
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(spark, stage(spark, docs, DATA), "test-stage")
        assert docs.columns == before.columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
        assert kept[-1].items() <= kept[-2].items()
    model = quality.train(table(spark, DATA, "documents"), table(spark, DATA, "labels"))
    scores = {r.doc_id: r.score for r in quality.score(table(spark, DATA, "documents"), model).select("doc_id", "score").collect()}
    assert set(kept[1]) == {d for d in kept[0] if scores[d] >= 0.3}
    assert len(kept[2]) > 0.9 * len(kept[1])
    order = sorted(kept[2])
    found = brute([kept[2][d] for d in order], 5, 80)
    assert set(kept[3]) == {d for d, (n, c) in zip(order, found, strict=True) if order[c] == d}
    items = [decontamination.normalised(r.text) for r in table(spark, DATA, "benchmark").collect()]
    exact = {d for d, t in kept[3].items() if any(i in decontamination.normalised(t) for i in items)}
    assert not exact & set(kept[4]) and len(kept[4]) >= len(kept[3]) - 2 * len(exact) - 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    e = pieces.encoder(PIECES)
    assert {r.doc_id for r in last} == set(kept[4]) and all(r.round_trip and list(r.ids) == e.encode(kept[4][r.doc_id]).tolist() for r in last)


def odd_rows(spark):
    """Null ids and texts, empty, repeated and long texts, null languages and sources, and columns named like those that stages add."""
    docs = table(spark, DATA, "documents")
    a, b = (r.text for r in docs.filter("n_chars BETWEEN 900 AND 3000 AND lang = 'en'").orderBy("doc_id").limit(2).collect())
    big = (1 << 53) + 1
    rows = [(big, a, "en", "s"), (None, a, None, None), (big, a, "en", "s"), (4, None, "en", "s"), (5, "", None, "s"), (6, " ", "de", None), (7, b * 30, "en", "s"), (8, "123", "en", "s"), (None, None, None, None), (-big, b, "en", "s")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, `quality score` string, `row key` string, `Row Key'` int, `gone id` timestamp, id decimal(20, 3), hash array<string>"
    return spark.createDataFrame([(*r, len(r[1] or ""), None, "q", "k", 1, None, None, ["x", None]) for r in rows], schema), a, b


def test_stages_on_odd_rows(spark):
    docs, a, b = odd_rows(spark)
    all_ = sorted(map(repr, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.schema.simpleString() == docs.schema.simpleString(), name
        got = sorted(map(repr, kept.collect()))
        left = list(all_)
        for r in got:  # each is a whole row of the input, and none comes more often than there
            left.remove(r)
    kept = corpus_pipeline.known_language(spark, docs, DATA).collect()
    assert sorted(str(r.text)[:5] for r in kept) == sorted([a[:5]] * 3 + [b[:5]] * 2)
    kept = corpus_pipeline.distinct(spark, docs, DATA).collect()
    assert [r.text for r in kept].count(a) == 1 and len(kept) == 7  # thirty times the same text has hardly other shingles
    assert len(corpus_pipeline.decontaminated(spark, docs, DATA).collect()) == len(all_)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert len(last) == len(all_) and all(r.round_trip for r in last) and sum(r.doc_id is None for r in last) == 2 and sum(r.n_ids == 0 for r in last) == 3


def test_stages_of_nothing(spark):
    docs = odd_rows(spark)[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0

"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import base64
import functools
import glob
import hashlib
import random
import struct
import time
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.llm import common, decontamination, fingerprints, jaccard, languages, pieces, quality, shards, token_files, toxicity, warc
from orrery.llm.common import scratch

from ..conftest import DATA

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, start string, key string, range string, slot string, shard string, sig string, ll string"
WORDS = "der und nicht the of and house tree water la maison verte que los las casas river mountain sky ocean light".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


#: The next number that a 64-bit float can't hold.
BIG = (1 << 53) + 1
TEXTS = [None, "", " ", "one", "one two", "One TWO", prose(1, 40), prose(1, 40), prose(1, 40) + " Extra", prose(2, 4000), "a  b\n\tc", "日本語 😀 é", "<|endoftext|> it's", prose(3, 60), prose(3, 30) + " CHANGED " + prose(4, 30), "x" * 5000]


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + 3 * i, t, ["en", "de", None][i % 3], f"src{i % 2}", len(t or ""), "score", "s", "k", "r", "s", "s", "s", "l") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, TEXTS).unionByName(docs_of(spark, [TEXTS[6]], 18)).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def whole_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library():
    e, rng = token_files.Encoder(BPE), random.Random(5)
    odd = ["".join(rng.choice("ab'sé.1 \n日😀,-\t\xa0") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    marks = ["".join(rng.choice(["ab", "é", ".", ",", "\n", " ", "'s", "_", "½", "1"]) for _ in range(rng.randint(1, 25))) for _ in range(1_000)]
    special = ["hi <|endoftext|> there", "a<|endoftext|>b", "<|endoftext|>", "word. <|endoftext|>.\nNext", "\x01 \x02 \x04a. b\x00c, \x03"]
    for t in [*filter(None, TEXTS), *odd, *marks, *special, " a", "a ", "it's they'll ''", "a\x1c b"]:
        assert np.frombuffer(e(t), e.type).tolist() == whole_ids(t), t
    assert 50256 in whole_ids(special[0])
    small = token_files.Encoder(BPE, 4_000)  # forgets again and again
    for t in [*filter(None, TEXTS), *odd, *marks]:
        assert np.frombuffer(small(t), e.type).tolist() == np.frombuffer(e(t), e.type).tolist()


def test_token_files_round_trip(spark, docs):
    folder = scratch(spark, "test")
    manifest = token_files.write_token_files(spark, docs, folder, BPE, docs_a_range=4, file_bytes=60)
    assert manifest.count() > 2 and manifest.filter("part > 0").count()
    got = token_files.read_token_files(spark, folder, manifest, with_ids=True).toPandas().sort_values("start")
    want = sorted([(r.doc_id, [*whole_ids(r.text), 0]) for r in docs.select("doc_id", "text").collect()], key=lambda x: x[0])
    assert got.doc_id.tolist() == [d for d, _ in want]
    assert [list(x) for x in got.ids] == [i for _, i in want]
    assert got.start.tolist() == np.cumsum([0, *[len(i) for _, i in want][:-1]]).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for _, i in want]


def test_one_document_is_read_by_its_index(spark, docs):
    folder = scratch(spark, "test")
    without = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    row = token_files.write_token_files(spark, docs.select("doc_id", "text").unionByName(without), folder, BPE).first()
    content = open(row.path.removeprefix("file://"), "rb").read()
    dictionary = next(open(p, "rb").read() for p in glob.glob(f"{folder.removeprefix('file://')}/*.zdict"))
    assert token_files.read_document(content, dictionary, 15).tolist() == [*whole_ids("One TWO"), 0]
    assert token_files.read_document(content, dictionary, 16) is None and token_files.read_document(content, dictionary, 0).tolist() == [0]
    with pytest.raises(ValueError, match="dictionary"):
        token_files.read_document(content, b"other", 15)


def test_dictionary_is_shared(spark):
    many = docs_of(spark, [prose(i, 300) for i in range(1200)])
    dictionary = token_files.train_dictionary(many, BPE, 0)
    assert len(dictionary) > 1000
    folder = scratch(spark, "test")
    got = token_files.read_token_files(spark, folder, token_files.write_token_files(spark, many, folder, BPE))
    assert got.count() == 1200


def test_token_files_of_nothing(spark, none):
    folder = scratch(spark, "test")
    assert token_files.read_token_files(spark, folder, token_files.write_token_files(spark, none, folder, BPE)).count() == 0


def test_token_files_without_ids(spark):
    rows = [(None, "a"), (5, "b"), (None, "c d"), (BIG, "e"), (-3, None)]
    folder = scratch(spark, "test")
    manifest = token_files.write_token_files(spark, spark.createDataFrame(rows, "doc_id long, text string"), folder, BPE)
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.read_token_files(spark, folder, manifest).collect())
    assert [d for _, d, _ in got] == [None, None, -3, 5, BIG] and [x for x, _, _ in got] == np.cumsum([0, *(n for _, _, n in got[:-1])]).tolist()


def test_token_files_plan_does_not_grow(spark, docs):
    """Many ranges and one doc_id for all rows: the ranges are still small and the order is whole."""
    same = docs.select(F.lit(1).alias("doc_id"), "text")
    folder = scratch(spark, "test")
    manifest = token_files.write_token_files(spark, same, folder, BPE, docs_a_range=2)
    assert manifest.agg(F.max("docs")).first()[0] <= 8 and manifest.count() >= 4
    got = token_files.read_token_files(spark, folder, manifest)
    assert got.count() == same.count() and got.select("start").distinct().count() == got.count()


# ---- 2


def plain_lpt(sizes, shards_):
    """Item by item: descending sizes, each to the least load, then the least number."""
    loads, given = [0] * shards_, {}
    for s in sorted(sizes, reverse=True):
        i = min(range(shards_), key=lambda i: (loads[i], i))
        loads[i] += s
        given[s, i] = given.get((s, i), 0) + 1
    return loads, given


def test_lpt_by_hand():
    assert shards.lpt([(3, 2), (2, 3)], 2) == ([[1, 1], [2, 1]], [7, 5])
    assert shards.lpt([], 3) == ([], [0, 0, 0])
    with pytest.raises(ValueError):
        shards.lpt([(1, 1)], 0)


@given(st.dictionaries(st.integers(1, 3_000), st.integers(1, 60), max_size=12), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_histogram_gives_what_plain_lpt_gives(histogram, n):
    got, loads = shards.lpt(list(histogram.items()), n)
    want, each = plain_lpt([s for s, k in histogram.items() for _ in range(k)], n)
    assert loads == want
    assert all(got[j][i] == each.get((s, i), 0) for j, s in enumerate(histogram) for i in range(n))


def test_shards_are_those_of_plain_lpt(spark):
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    got = shards.shard_documents(spark, frame).toPandas()
    groups = {}
    for r in frame.select("text").collect():
        groups[r.text or ""] = groups.get(r.text or "", 0) + len((r.text or "").encode()) + 8
    loads = got.groupby("shard")["size"].sum().reindex(range(24), fill_value=0)
    assert loads.tolist() == plain_lpt(groups.values(), 24)[0]
    assert loads.max() - loads.min() <= max(groups.values())


def test_shards(spark, docs):
    got = shards.shard_documents(spark, docs, 3).toPandas()
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert len(got) == docs.count() and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert got.assign(t=got.doc_id.map(texts)).groupby("t").shard.nunique().max() == 1
    assert got["size"].tolist() == [len(texts[d].encode()) + 8 for d in got.doc_id]
    assert got["text_crc32"].tolist() == [zlib.crc32(texts[d].encode()) for d in got.doc_id]


def test_shards_and_archives_where_all_keys_are_hot(spark, docs, monkeypatch):
    many = docs.unionByName(docs.filter("text = 'one two'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).withColumn("doc_id", F.col("n") + 100).drop("n"))
    pages = many.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example/").alias("url"), F.col("text").alias("html"))
    found = []
    for hot in (1_000, 2):
        monkeypatch.setattr(common, "HOT_ROWS", hot)
        folder = scratch(spark, "warc")
        read = warc.read_archives(spark, folder, warc.write_archives(spark, pages, folder))
        found.append([sorted(map(repr, x.collect())) for x in (shards.shard_documents(spark, many), read)])
    assert found[0] == found[1] and len(found[0][0]) == many.count() == len(found[0][1])


def test_shards_of_nothing(spark, none):
    assert shards.shard_documents(spark, none).count() == 0


# ---- 3


def test_framing():
    for n in (0, 1, 4096, 4097, 20_000):
        body = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(body)) == body
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    for wrong in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(wrong)


PAGES = [(1, "http://a/", "<p>x</p>", 1), (2, "http://b/", "<p>x</p>", 1), (3, None, None, 1), (4, "http://c/", "", 1), (5, "http://d/\r\nX: y", "é" * 30_000, 1), (6, "u", "é" * 30_000 + "!", 1), (6, "u", "é" * 30_000 + "!", 1), (None, "n", "<p>x</p>", 1), (7, "v", "z" * 16_200, 1)]


@pytest.mark.parametrize("archive_bytes", [300, 1 << 20])
def test_archives_round_trip(spark, archive_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, kept long")
    folder = scratch(spark, "test")
    manifest = warc.write_archives(spark, pages, folder, archive_bytes=archive_bytes)
    got = [tuple(r) for r in warc.read_archives(spark, folder, manifest).collect()]
    want = []
    for page, _, html, _ in PAGES:
        body = (html or "").encode()
        kept = max(p for p, _, h, _ in PAGES if (h or "") == (html or "") and p is not None)
        want.append((page, len(body), warc.digest_of(body), "response" if page == kept else "revisit", None if page == kept else kept))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_broken_segments_are_errors(spark):
    folder = scratch(spark, "test")
    page = warc.records_of(1, "u", b"x" * 40_000, warc.digest_of(b"x" * 40_000), "<urn:x>", None, 16_384)
    from orrery.llm.common import write_atomically

    for wrong in (page[:1] + page[2:], page[:-1], page + page[1:2]):
        folder = scratch(spark, "test")
        write_atomically(folder, "a.warc.gz", b"".join(wrong))
        with pytest.raises(Exception, match="segments|total"):
            warc.reassembled(warc.read_records(spark, folder).filter("segment is not null")).collect()


def test_references_resolve_and_names_are_unique(spark):
    folder = scratch(spark, "test")
    warc.write_archives(spark, spark.createDataFrame(PAGES, "page_id long, url string, html string, kept long"), folder, archive_bytes=300)
    heads = []
    for file in glob.glob(f"{folder.removeprefix('file://')}/*.warc.gz"):
        found = [warc.parsed(raw)[0] for raw in warc.members(open(file, "rb").read())]
        assert found[0]["warc-type"] == "warcinfo" and found[0]["warc-filename"] == file.rsplit("/", 1)[1]
        heads += found
    names = [h["warc-record-id"] for h in heads]
    assert len(set(names)) == len(names)
    responses = {h["warc-record-id"]: h for h in heads if h["warc-type"] == "response"}
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert revisits and all(responses[h["warc-refers-to"]]["warc-payload-digest"] == h["warc-payload-digest"] for h in revisits)


def test_reading_is_linear():
    rng = random.Random(1)
    one = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], rng.randbytes(3_000))
    archive = one * (32 * 1024 * 1024 // len(one))
    began = time.perf_counter()
    assert sum(1 for _ in warc.members(archive)) == len(archive) // len(one)
    assert time.perf_counter() - began < 4
    with pytest.raises(ValueError, match="cut short"):
        list(warc.members(one[:-3]))


def test_archives_of_nothing(spark):
    folder = scratch(spark, "test")
    manifest = warc.write_archives(spark, spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert manifest.count() == 0


# ---- 4


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_the_plain_table():
    rng = random.Random(2)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))
        assert decontamination.myers(item, text) == plain_distance(item, text)


def edited(text, errors, seed):
    rng, out = random.Random(seed), list(text)
    for _ in range(errors):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice([[], ["q"], [out[i], "q"]])
    return "".join(out)


def test_contaminations(spark, none):
    items = [(1, prose(50, 20)), (2, prose(51, 25)), (3, None), (4, " ... "), (2, prose(51, 25)), (5, "abc")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [prose(9, 200) + " " + edited(items[0][1], e, e) + " " + prose(8, 100) for e in (0, 3, 6, 9, 12, 20)] + [items[1][1].upper().replace(" ", "\n\n"), prose(60, 500), None, "", "xabcx"]
    table = docs_of(spark, texts)
    got = {(r.doc_id, r.item_id): r.distance for r in decontamination.contaminations(table, benchmark).collect()}
    want = {}
    for i, t in enumerate(texts):
        for k, item in {(k, x) for k, x in items if x and decontamination.normalised(x)}:
            item = decontamination.normalised(item)
            d = plain_distance(item, decontamination.normalised(t or ""))
            if d <= int(decontamination.RATE * len(item)):
                want[(3 * i, k)] = d
    assert got == want and len(want) >= 4
    kept = {r.doc_id for r in decontamination.clean(table, benchmark).collect()}
    assert kept == {3 * i for i in range(len(texts))} - {d for d, _ in want}
    assert decontamination.contaminations(none, benchmark).count() == 0
    assert decontamination.contaminations(table, benchmark.limit(0)).count() == 0
    assert decontamination.clean(table, benchmark.limit(0)).count() == len(texts)


# ---- 5


def test_languages(spark, docs, none):
    labelled = spark.createDataFrame([(prose_of("en", i), "en") for i in range(40)] + [(prose_of("de", i), "de") for i in range(40)], "text string, lang string")
    rows = [(i, prose_of(["en", "de"][i % 2], 100 + i, 30), False, None, f"{['en', 'de'][i % 2]}.example.org") for i in range(20)]
    rows += [(20, None, False, None, "de.example.org"), (21, "", False, "de-AT", None), (22, "", False, "??", "nowhere"), (23, "", False, None, "new.example.org"), (24, f"<script>{prose_of('en', 1)}</script><p>{prose_of('de', 7)}", True, "en", "x.de"), (24, f"<script>{prose_of('en', 1)}</script><p>{prose_of('de', 7)}", True, "en", "x.de")]
    rows += [(30 + i, prose_of("de", 300 + i), False, "de", None) for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, is_markup boolean, declared string, host string")
    got = {r.doc_id: r for r in languages.identify(table, labelled, ["doc_id"]).collect()}
    assert all(got[i].lang == ["en", "de"][i % 2] and got[i].confidence > 0.9 for i in range(20))
    assert got[20].lang == "de" and got[21].lang == "de" and got[24].lang == "de"
    assert 0 < got[22].confidence <= 1 and got[23].lang in ("en", "de")
    assert languages.identify(table.limit(0), labelled, ["doc_id"]).count() == 0
    assert {r.lang for r in languages.identify(table, labelled.limit(0), ["doc_id"]).collect()} == {"und"}
    gone = {r.doc_id for r in languages.rejected(docs, labelled).collect()}
    assert {0, 3, 6} <= gone and 18 not in gone


def plain_fusion(rows, langs, logs):
    """lang and posterior of each (text, declared, host), by loops over bytes and dictionaries."""
    alone, lls, domains = [], [], []
    for text, _, host in rows:
        data = bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())
        data = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in data)
        runs = [data[i : i + 3] for i in range(len(data) - 2) if data[i + 1 : i + 3] != b"  "]
        ll = np.zeros(len(langs))
        for a, b, c in runs:
            ll += logs[(((a * 961 + b) * 961 + c) * 40_503 >> 7) & (languages.SLOTS - 1)]
        ll *= min(len(runs), languages.RUNS) / max(1, len(runs))
        lls.append(ll)
        alone.append(np.exp(ll - ll.max()) / np.exp(ll - ll.max()).sum())
        labels = (host or "").lower().split(".")
        domains.append(host.lower() if host and host.replace(".", "").isdigit() else ".".join(labels[-3 if labels[-2:] == ["co", "uk"] else -2 :]))
    prior = (sum(alone) + 1) / (len(rows) + len(langs))
    total = lambda keys, key: sum((a for a, k in zip(alone, keys, strict=True) if k == key), np.zeros(len(langs)))
    hosts, tags = [(h or "").lower() for _, _, h in rows], [(d or "").split("-")[0] for _, d, _ in rows]
    ends = ["" if h.replace(".", "").isdigit() or "." not in h else h.split(".")[-1] for h in hosts]

    def given(values, value):
        if not value:
            return np.zeros(len(langs))
        all_ = sum(a for a, v in zip(alone, values, strict=True) if v)
        return np.log((total(values, value) + languages.PSEUDO) / (all_ + languages.PSEUDO * (len(set(values) - {""}) + 1)))

    out = []
    for i, own in enumerate(alone):
        score = lls[i] + given(tags, tags[i]) + given(ends, ends[i])
        if hosts[i]:
            of_domain = (total(domains, domains[i]) - own + languages.STRENGTH * prior) / (domains.count(domains[i]) - 1 + languages.STRENGTH)
            score += np.log((total(hosts, hosts[i]) - own + languages.STRENGTH * of_domain) / (hosts.count(hosts[i]) - 1 + languages.STRENGTH))
        else:
            score += np.log(prior)
        p = np.exp(score - score.max())
        out.append((langs[int(p.argmax())], (p / p.sum()).max()))
    return out


@pytest.mark.parametrize("large", [0, 3, 1_000])
def test_fusion_equals_plain_loops(spark, large, monkeypatch):
    """Hosts that are broadcast, hosts that aren't, and both, give the same."""
    monkeypatch.setattr(languages, "LARGE", large)
    rng = random.Random(7)
    hosts = ["a.co.uk", "b.co.uk", "x.a.co.uk", "10.0.0.1", "10.0.0.2", "www.site.example", "BLOG.site.example", "localhost", "", None]
    rows = [(prose_of(["en", "de"][rng.random() < 0.4], i, rng.choice([0, 1, 2, 12])), rng.choice([None, "en-US", "de", "fr", "??"]), rng.choice(hosts + ["a.co.uk"] * 6)) for i in range(120)] + [(None, None, None), ("", "de", "b.co.uk")]
    rows = [(t, d if d != "??" else None, h) for t, d, h in rows]
    labelled = spark.createDataFrame([(prose_of(x, i), x) for i in range(40) for x in ("en", "de")], "text string, lang string")
    table = spark.createDataFrame([(i, t, False, d, h, "clash") for i, (t, d, h) in enumerate(rows)], "doc_id long, text string, is_markup boolean, declared string, host string, ll string")
    langs, logs = languages.train(labelled)
    got = {r.doc_id: r for r in languages.identify(table, labelled, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i, (lang, posterior) in enumerate(plain_fusion(rows, langs, logs.astype(float))):
        assert got[i].lang == lang and got[i].confidence == pytest.approx(posterior, abs=1e-4)


def test_long_texts_are_cut_between_runs():
    import pyarrow as pa

    text = prose(3, 400_000)
    part = next(languages.tokens.parts(pa.array([text])))
    whole = languages.slots(part)[1]
    assert len(part.data) > languages.tokens.PART_BYTES
    assert np.concatenate([languages.slots(b)[1] for b in languages.blocks(part)]).tolist() == whole.tolist()


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Všetci ľudia sa rodia slobodní a sebe rovní, čo sa týka ich dôstojnosti a práv.",
    base64.b64encode(hashlib.sha512(b"x").digest() * 4).decode(),
    " ".join("".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=3 + i % 6)) for i in range(80)),
    "xqzv krwj pqtl gghk",
]


def test_unseen_languages_are_rejected_and_labelled_ones_stay(spark):
    known = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    foreign = spark.createDataFrame([(10**6 + i, t, None, "foreign.example.org" if i % 2 else None) for i, t in enumerate(FOREIGN)], known.schema)
    seen = known.filter("doc_id % 2 = 0")
    held_out = known.filter("doc_id % 2 = 1 AND text RLIKE '[A-Za-z]{3}'")
    gone = {r.doc_id for r in languages.rejected(held_out.unionByName(foreign), seen).collect()}
    assert gone == {10**6 + i for i in range(len(FOREIGN))}
    found = {r.doc_id: r for r in languages.identify(languages.of_documents(held_out.unionByName(foreign)), seen, ["doc_id"]).collect()}
    assert all(found[d].lang == languages.UNKNOWN for d in gone)
    right = [found[r.doc_id].lang == r.lang for r in held_out.select("doc_id", "lang").collect()]
    assert sum(right) > 0.98 * len(right)
    # Labelled rows only count with a language: a corpus labelled as unknown has no model of its own.
    langs, logs = languages.train(seen)
    assert languages.UNKNOWN in langs and np.allclose(np.exp(logs.astype(float)).sum(0), 1, atol=1e-3)


def prose_of(lang, seed, n=12):
    rng = random.Random(seed)
    return " ".join(rng.choice({"en": ["the", "which", "with", "house", "why", "they", "thing"], "de": ["der", "nicht", "und", "schön", "ich", "straße", "zwölf"]}[lang]) for _ in range(n))


def test_visible_text():
    assert " ".join(languages.visible("<style>a</style><!-- b --><p class='x'>c &amp; d</p><script>e</SCRIPT >").split()) == "c & d"


# ---- 6 and 8


def test_folding():
    assert toxicity.folded("You 1D10T, cl0wn! ｉｄｉｏｔ іdіоt worthle55 m0r0n tr@sh") == " you idiot clown idiot idiot worthless moron trash "
    assert toxicity.folded("") == "  "


def labelled_docs(spark, bad, n=300):
    texts = [prose(i, 30) + (" " + bad(i) if i % 3 == 0 else "") for i in range(n)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (n, "", "x"), (0, texts[0], "x")], "doc_id long, text string, score string")
    return frame, [(i, int(i % 3 == 0)) for i in range(n)] + [(0, 1), (None, 1), (5, None)]


def test_toxicity(spark):
    frame, labels = labelled_docs(spark, lambda i: ["grumblor", "Grumb1or", "snargle snargle"][i % 3] if i % 2 else "grumblors snargled")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(frame, labels).toPandas()
    assert len(got) == 303 and got.score.between(0, 1).all()
    known = got[got.doc_id.notna() & (got.doc_id < 300)]
    assert ((known.doc_id % 3 == 0) == (known.predicted == 1)).all()
    assert (known.held_out == known.doc_id.map(lambda d: zlib.crc32(str(int(d)).encode()) % 3 == 1)).all()
    assert (got[~got.index.isin(known.index)].predicted == 0).all()
    assert toxicity.toxicity(frame.limit(0), labels).count() == 0
    assert set(toxicity.toxicity(frame, labels.limit(0)).toPandas().score) == {0.5}


def test_exceptions_cancel_entries():
    lexicon = toxicity.Lexicon({" grumb": 2.0, " grumblor ": 3.0}, [" mister grumblor "], (1.0, 1.0), -1.0)
    a = lexicon.automaton()
    assert lexicon.hits(" a grumblor b ", a) == [(2, 12, 3.0)]
    assert lexicon.hits(" mister grumblor b ", a) == []


def test_quality(spark):
    frame, labels = labelled_docs(spark, lambda i: "WIN!!! $$$ *** " * 20)
    labels = spark.createDataFrame([(d, None if x is None else 1 - x) for d, x in labels], "doc_id long, quality int")
    got = quality.quality(frame, labels).toPandas()
    known = got[got.doc_id.notna() & (got.doc_id < 300)]
    assert len(got) == 303 and got.score.between(0, 1).all()
    assert ((known.doc_id % 3 == 0) == (known.predicted == 0)).mean() > 0.98
    assert (known.held_out == known.doc_id.map(lambda d: zlib.crc32(str(int(d)).encode()) % 5 == 0)).all()
    assert quality.quality(frame.limit(0), labels).count() == 0
    assert set(quality.quality(frame, labels.limit(0)).toPandas().score) == {0.5}


def test_samples_of_empty_texts(spark):
    frame = spark.createDataFrame([(i, ["", None, " "][i % 3]) for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    assert quality.quality(frame, labels).filter("score between 0 and 1").count() == 12
    assert toxicity.toxicity(frame, labels).filter("score between 0 and 1").count() == 12


def test_held_out_accuracy(spark):
    """Labels of the held-out folds, none of which a model has seen."""
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    for found, label, least in ((toxicity.toxicity(docs, labels), "toxic", 0.85), (quality.quality(docs, labels), "quality", 0.95)):
        rows = found.filter("held_out").join(labels, "doc_id").select("score", "predicted", label).toPandas()
        bad, good = rows[rows[label] == 0], rows[rows[label] == 1]
        assert len(bad) > 10 and len(good) > 5
        pairs = (good.score.to_numpy()[:, None] > bad.score.to_numpy()) + 0.5 * (good.score.to_numpy()[:, None] == bad.score.to_numpy())
        assert pairs.mean() > least and (rows.predicted == rows[label]).mean() > least


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    m = quality.SLOTS + quality.STATISTICS
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), 0.1, rng.normal(0, 0.1, m), rng.normal(0, 0.1, (m, quality.RANK)))
    f = quality.Features(rng.normal(0, 1, (1, quality.STATISTICS)), np.zeros(5, int), np.arange(5), rng.normal(0, 1, 5))
    _, feature, x = model.rows(f)
    plain = 0.1 + model.weight[feature] @ x + sum(model.factors[feature[i]] @ model.factors[feature[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert model.scores(f)[0] == pytest.approx(1 / (1 + np.exp(-plain)))


# ---- 7


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dealt_rows_join_as_others(spark, monkeypatch, how):
    monkeypatch.setattr(common, "HOT_ROWS", 7)
    rows = spark.createDataFrame([(k, i, f"{i}") for k in range(9) for i in range(k * k)] + [(None, i, "n") for i in range(20)] + [(8, 1, "1")] * 30, "k long, i long, copy string")
    facts = spark.createDataFrame([(k, f"fact {k}") for k in range(3, 12)] + [(None, "none")], "k long, copies string")
    got, want = common.join_dealt(rows, facts, ["k"], rows.count(), how), rows.join(facts, "k", how)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    known = common.join_dealt(rows, facts, ["k"], rows.count(), how, by=F.col("i"), counts=rows.groupBy("k").count())
    assert sorted(map(repr, known.collect())) == sorted(map(repr, want.collect()))
    assert common.join_dealt(rows.limit(0), facts, ["k"], 0, how).count() == 0


def brute(texts, width=3, percent=90):
    import re

    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("width", "percent", "hot"), [(3, 90, 100), (3, 90, 3), (5, 80, 100), (5, 80, 3)])
def test_components(spark, monkeypatch, width, percent, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rng, texts = random.Random(3), list(TEXTS)
    for family in range(4):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):
        chain[i * 8] = f"d{i}"
        texts.append(" ".join(chain))
    passage = prose(77, 60)
    texts += [passage + " " + " ".join(f"u{i}x{j}" for j in range(60)) for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark, docs_of(spark, texts), width, percent).collect()}
    want = {3 * i: (n, 3 * c) for i, (n, c) in enumerate(brute(texts, width, percent))}
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 30


def test_components_of_odd_rows(spark, docs, none):
    got = jaccard.near_duplicates(spark, docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")).filter("text = 'one two'"))).collect()
    assert len(got) == docs.count() + 1
    by = {r.doc_id: r.component_id for r in got}
    assert by[18] == by[21] == 18 and by[0] == 0 and by[3] == 3 and by[6] == 6 and by[12] == by[15] == by[None] == 12
    assert jaccard.near_duplicates(spark, none).count() == 0
    kept = {r.doc_id for r in jaccard.one_of_each(spark, docs).collect()}
    assert 18 in kept and 21 not in kept and {0, 3, 6} <= kept


# ---- 9


@pytest.mark.parametrize("fragments", [2, 7, 5_000])
@pytest.mark.parametrize("whole", [False, True])
def test_census_counts_alike_in_few_and_in_many_fragments(spark, monkeypatch, fragments, whole):
    """Held against plain counts; with 5,000 fragments most messages have one hash, and batches of 50 hashes make many of them."""
    monkeypatch.setattr(jaccard, "BATCH", 50)
    draw = random.Random(5)
    sets = [sorted(draw.sample([(k * 0x9E3779B97F4A7C15) % (1 << 64) for k in range(1, 90)], draw.randint(1, 30))) for _ in range(40)]
    rows = [(hashlib.blake2b(bytes([k]), digest_size=16).digest(), len(s), np.array(s, "<u8").tobytes()) for k, s in enumerate(sets)]
    found = jaccard.census(spark.createDataFrame(rows, "sig binary, n long, hashes binary"), fragments, 90, whole).collect()
    times = {h: sum(h in s for s in sets) for s in sets for h in s}
    wanted = {}
    for (sig, n, _), s in zip(rows, sets, strict=True):
        unique = sum(times[h] == 1 for h in s)
        shared = [h - (1 << 64) * (h >> 63) for h in sorted((h for h in s if times[h] > 1), key=lambda h: (times[h], h))]
        wanted[sig] = (n, unique, shared if whole and unique <= n - -(-n * 90 // 100) else None)
    assert {bytes(r.sig): (r.n, r.unique, r.shared) for r in found} == wanted


def best_score(v, text):
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        found = [best[a] + x[1] for a in range(max(0, end - v.longest), end) if (x := v.known.get(text[a:end]))]
        if not v.known.get(text[end - 1]):
            found.append(best[end - 1] + v.fallback * len(v.bytes_ids(text[end - 1])))
        best[end] = max(found)
    return best[-1]


def test_ids_equal_the_library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    e, rng = pieces.Encoder(pieces.Vocabulary.read(PIECES)), random.Random(4)
    assert e.v.merges
    texts = [t for t in TEXTS if t] + ["the" * 700, "a" * 3_000, " a  b ", "   ", "word. Next, one.\nLine", "².x ². y", "\x01 \x04a. b"]
    texts += ["".join(rng.choice("the abn 日\n.,²'s") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for t in texts:
        assert e.encode(t).tolist() == model.encode(t), t
        assert e.decode(e.encode(t)) == t
    assert e.decode(e.encode("▁x ▁")) == "▁x ▁"
    small = pieces.Encoder(e.v, 4_000)  # forgets again and again
    assert all(small.encode(t).tolist() == e.encode(t).tolist() for t in texts)


def test_unigram_search_equals_the_plain_table():
    rng = random.Random(4)
    found = {c: -6.0 for c in "abc "} | {"".join(rng.choice("abc ") for _ in range(rng.randint(2, 5))): -rng.uniform(3, 12) for _ in range(60)}
    v = pieces.Vocabulary({p: (256 + i, x) for i, (p, x) in enumerate(found.items())}, {b: b for b in range(256)}, False)
    e = pieces.Encoder(v)
    score = {256 + i: x for i, x in enumerate(found.values())}
    for _ in range(300):
        t = "".join(rng.choice("abc dé") for _ in range(rng.randint(1, 80)))
        ids = e.encode(t)
        assert e.decode(ids) == t
        assert sum(score.get(i, v.fallback) for i in ids.tolist()) == pytest.approx(best_score(v, " " + t))


def test_pairs_follow_as_merging_says():
    """Edges that go through their merges together against merging the two pieces' characters in full."""
    v, rng = pieces.Vocabulary.read(PIECES), random.Random(9)

    def merged(text):
        parts = list(text)
        while len(parts) > 1 and (best := v._best(parts)):
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    ids = sorted(v.text_of)
    some = [(rng.choice(ids), rng.choice(ids)) for _ in range(3_000)]
    # Pieces cut in two are the pairs most likely to be merged.
    some += [(v.known[p[:k]][0], v.known[p[k:]][0]) for p in rng.sample(sorted(v.known), 3_000) for k in range(1, len(p)) if p[:k] in v.known and p[k:] in v.known]
    for a, b in some:
        assert v.may_follow(a, b) == (merged(v.text_of[a] + v.text_of[b]) == [v.text_of[a], v.text_of[b]])


@pytest.mark.parametrize("text", [" " + prose(6, 4_000), " " + "the" * 5_000, "a" * 9_000, "日" * 500, ""])
def test_stream_forgets_what_is_committed(text):
    v, out, times = pieces.Vocabulary.read(PIECES), [], []
    assert pieces.stream(text, v, lambda ids: (out.extend(ids), times.append(1))) < 8 * v.longest
    assert b"".join(v.bytes_of[i] for i in out).decode() == text and len(times) >= len(text) // 100


def test_paths_that_never_converge_are_kept():
    """Under these scores two paths go on side by side to the end; nothing is committed too early and the work stays linear."""
    v = pieces.Vocabulary({"a": (256, -5.0), "aa": (257, -3.0)}, {b: b for b in range(256)}, False)
    out = []
    pieces.stream("a" * 5_001, v, out.extend)
    assert out.count(257) == 2_500 and out.count(256) == 1


def test_encoded_documents(spark, docs, none):
    got = pieces.encoded(docs, PIECES, with_ids=True).collect()
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert len(got) == docs.count() and all(r.round_trip for r in got)
    assert all(r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
    assert pieces.encoded(none, PIECES).count() == 0


# ---- ids of any size


def test_ids_beside_nulls_are_exact(spark):
    item = prose(50, 20)
    frame = spark.createDataFrame([(BIG, item), (None, item), (-BIG, "clean")], "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame([(BIG, item), (None, "elsewhere entirely")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, toxic int, quality int")
    want = {BIG, None, -BIG}
    assert {r.doc_id for r in pieces.encoded(frame, PIECES).collect()} == want
    assert {r.doc_id for r in toxicity.toxicity(frame, labels).collect()} == want
    assert {r.doc_id for r in quality.quality(frame, labels).collect()} == want
    assert {r.doc_id for r in fingerprints.fingerprints(frame).collect()} == want
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminations(frame, benchmark).collect()} == {(BIG, BIG), (None, BIG)}
    assert {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(spark, frame).collect()} == {(BIG, BIG), (None, BIG), (-BIG, -BIG)}
    pages = spark.createDataFrame([(BIG, "u", "x"), (None, "u", "x"), (3, "u", "x")], "page_id long, url string, html string").coalesce(1)
    folder = scratch(spark, "test")
    assert {(r.page_id, r.refers_to) for r in warc.read_archives(spark, folder, warc.write_archives(spark, pages, folder)).collect()} == {(BIG, None), (None, BIG), (3, BIG)}


def test_clean_passes_every_type_untouched(spark):
    frame = spark.sql("SELECT id AS doc_id, if(id = 2, null, 'some text') AS text, timestamp'2024-02-03 04:05:06.789' AS t, date'1999-01-02' AS d, cast(id / 3 AS decimal(30, 10)) AS c, array(id, null) AS a, named_struct('x', array('y', null), 'z', map('k', id)) AS s, if(id = 1, null, id + 9007199254740993) AS n, cast('ab' AS binary) AS b, cast(null AS int) AS e FROM range(4)").coalesce(1)
    benchmark = spark.createDataFrame([(1, "not in there")], "item_id long, text string")
    assert decontamination.clean(frame, benchmark).collect() == frame.collect()
    assert decontamination.clean(frame, benchmark).schema == frame.schema


# ---- 10


def test_fingerprints(spark, docs, none):
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == docs.count()
    order = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda x: (-x[0], x[1]))
    following = {}
    for (d, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        following.setdefault((d, t), []).append(n)
    by_id = {d: t for d, t in order}
    prints = {}
    for r in got:
        t = by_id[r.doc_id]
        assert r.n_chars == len(t) and prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        half = len(t) // 2
        assert r.edited_sha256 in {hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest() for n in following[(r.doc_id, t)]}
    assert fingerprints.fingerprints(none).count() == 0
    single = fingerprints.fingerprints(docs.filter("doc_id = 27")).first()
    assert single.near_next == 1.0


def test_likeness_is_near_the_similarity(spark):
    pairs = []
    for i in range(60):
        words = [f"w{i}x{j}" for j in range(400)]
        cut = 40 * (i % 10) + 20
        pairs.append((" ".join(words), " ".join(words[:cut] + [f"o{i}x{j}" for j in range(400 - cut)]), i % 10))
    df = spark.createDataFrame(pairs, "a string, b string, k int").select("k", "a", "b", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("near"))
    rows = df.toPandas()

    def similarity(a, b):
        s, t = ({tuple(x.split()[i : i + 5]) for i in range(396)} for x in (a, b))
        return len(s & t) / len(s | t)

    error = rows.near - [similarity(a, b) for a, b in zip(rows.a, rows.b, strict=True)]
    assert abs(error.mean()) < 0.02 and error.abs().max() < 0.2


def plain_bins(hashes, bins=128, probes=8):
    """Each bin's least hash; an empty one's is that of the first of its probes that has any, or of the filled one of least priority."""
    least = {}
    for x in hashes:
        at = (x & (1 << 64) - 1) >> 57
        least[at] = min(x, least.get(at, x))
    orders = fingerprints.probes(bins, probes)

    def priority(*numbers):
        seed = 42
        for x in numbers:
            seed = xxhash.xxh64_intdigest(struct.pack("<i", x), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    def value(b):
        for at in [b, *orders[b]]:
            if at in least:
                return least[at]
        return min((priority(b, at), x) for at, x in least.items())[1]

    return [value(b) for b in range(bins)] if least else []


def test_bins_equal_a_plain_version(spark):
    texts = ["", "one", "one two", *(" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((5, 6, 7, 9, 14, 40, 120, 400, 700, 1_500)))]
    shingles = fingerprints.shingles(F.col("t"))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", shingles.alias("h"), fingerprints.densified(shingles).alias("bins"), fingerprints.fingerprint(F.col("t")).alias("f")).collect()
    for r in got:
        want = plain_bins(r.h)
        assert list(r.bins) == want and r.f == "".join(f"{x & 255:02x}" for x in want)
        words = r.t.split()
        assert len(r.h) == (max(1, len(words) - 4) if words else 0)


def test_densified_bins_borrow_alike(spark):
    """Short texts fill few bins; what they borrow agrees as often as the texts are alike."""
    texts = [(" ".join(f"w{i}x{j}" for j in range(14)), " ".join([*(f"w{i}x{j}" for j in range(9)), *(f"v{i}x{j}" for j in range(5))])) for i in range(300)]
    near = spark.createDataFrame(texts, "a string, b string").select(fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))).toPandas().iloc[:, 0]
    assert near.mean() == pytest.approx(5 / 15, abs=0.04)


def test_likeness_where_one_text_fills_all_bins(spark):
    """Between 500 and 1,200 words one of two near copies may fill all bins and the other not; bins stand in one order all the same."""
    pairs = []
    for i in range(176):
        words = [f"w{i}x{j}" for j in range(500 + 4 * i)]
        pairs.append((i, " ".join(words), " ".join(words[:-100] + [f"o{i}x{j}" for j in range(100)]), len(words)))
    filled = lambda c: F.size(F.array_distinct(F.transform(fingerprints.shingles(F.col(c)), lambda x: F.shiftrightunsigned(x, 57))))
    bins = lambda c: F.transform(fingerprints.densified(fingerprints.shingles(F.col(c))), lambda x: F.shiftrightunsigned(x, 57))
    near = fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))
    got = spark.createDataFrame(pairs, "k int, a string, b string, n int").select("n", near.alias("near"), filled("a").alias("fa"), filled("b").alias("fb"), bins("a").alias("bins")).collect()
    assert sum((r.fa == 128) != (r.fb == 128) for r in got) >= 5
    for r in got:
        # 100 words changed at the end change 100 of the n - 4 shingles on either side.
        assert r.near == pytest.approx((r.n - 104) / (r.n + 96), abs=0.2)
        assert r.fa < 128 or list(r.bins) == list(range(128))


def test_no_python_in_the_fingerprints_plan(spark, docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

"""What keeps the Jaccard join's disk and rows in proportion to its input."""

import hashlib
import random

import numpy as np
import pyspark.sql.functions as F
import pytest

from orrery.llm import common, jaccard


def sig(k: int) -> bytes:
    return hashlib.blake2b(k.to_bytes(4, "little"), digest_size=16).digest()


@pytest.mark.parametrize("percent", [50, 80, 90, 97, 100])
def test_sizes_that_can_be_linked_are_of_neighbouring_kinds(percent):
    n = np.arange(1, 5_000)
    kinds = jaccard.size_kinds(n, percent).astype(int)
    most = np.minimum(n * 100 // percent, n[-1])
    assert (np.diff(kinds) >= 0).all() and (kinds[most - 1] - kinds <= 1).all() and kinds[0] > 0
    assert jaccard.size_kinds(np.array([1 << 60]), 100)[0] == 254


@pytest.mark.parametrize("fragments", [2, 7, 5_000])
@pytest.mark.parametrize("whole", [False, True])
def test_shingles_of_other_sizes_are_unique(spark, monkeypatch, fragments, whole):
    """A shingle that only much smaller or larger sets have as well counts as unique; others keep one order for all sets."""
    monkeypatch.setattr(jaccard, "BATCH", 200)
    draw = random.Random(6)
    pool = [(k * 0x9E3779B97F4A7C15) % (1 << 64) for k in range(1, 300)]
    sets = [sorted(draw.sample(pool, draw.choice((4, 5, 40, 43, 200, 205)))) for _ in range(30)]
    rows = [(sig(k), len(s), np.array(s, "<u8").tobytes()) for k, s in enumerate(sets)]
    found = jaccard.census(spark.createDataFrame(rows, "sig binary, n long, hashes binary").repartition(3), fragments, 10, whole, sized=True).collect()
    assert len(found) == len(sets)
    tight = jaccard.census(spark.createDataFrame(rows, "sig binary, n long, hashes binary").repartition(3), fragments, 80, False, sized=True)
    kinds = [int(jaccard.size_kinds(np.array([len(s)]), 80)[0]) for s in sets]
    want = {sig(k): sum(sum(h in s and abs(kinds[k] - kinds[j]) <= 1 for j, s in enumerate(sets)) == 1 for h in mine) for k, mine in enumerate(sets)}
    assert {bytes(r.sig): r.unique for r in tight.collect()} == want
    plain = {bytes(r.sig): r.unique for r in jaccard.census(spark.createDataFrame(rows, "sig binary, n long, hashes binary"), fragments, 80, False).collect()}
    assert sum(want.values()) > sum(plain.values())
    if whole:
        times = {h: sum(h in s for s in sets) for h in pool}
        for r in found:
            held = [h % (1 << 64) for h in r.shared or []]
            assert held == sorted(held, key=lambda h: (times[h], h))


def test_edges_are_read_until_their_ends_meet(spark, monkeypatch):
    """Stars, chains and trees against plain union; what is read is a few times the links, and nothing of it once they are joined."""
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    read, write = [], jaccard.written

    def counted(spark, df, name):
        out = write(spark, df, name)
        read.extend([out.count()] if name == "jaccard-edges" else [])
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    ids, draw = [sig(k) for k in range(400)], random.Random(1)
    ordered = sorted(ids[300:340])
    links = [(ids[0], x) for x in ids[1:150]] + [(ids[k], ids[150 + draw.randrange(k - 150)]) for k in range(151, 300)] + list(zip(ordered, ordered[1:], strict=False)) + [(ids[5], ids[5])]
    near = {x: {x} for x in ids}
    for a, b in links:
        joined = near[a] | near[b]
        near.update((x, joined) for x in joined)
    want = {x: min(c) for x, c in near.items()}
    nodes = spark.createDataFrame([(x, x) for x in ids], "sig binary, component binary")
    frame = spark.createDataFrame(links, "x binary, y binary")
    found = jaccard.components(spark, nodes, frame)
    assert {bytes(r.sig): bytes(r.component) for r in found.collect()} == want
    assert sum(read) <= 3 * 2 * len(links)
    read.clear()
    more = spark.createDataFrame([(ids[7], ids[399]), (ids[3], ids[8])], "x binary, y binary")
    again = {bytes(r.sig): bytes(r.component) for r in jaccard.components(spark, found, frame.union(more)).collect()}
    least = min(want[ids[7]], ids[399])
    assert again == {x: least if c == want[ids[7]] or x == ids[399] else c for x, c in want.items()}
    assert read == [2, 0]


def test_what_is_spent_goes(spark, monkeypatch):
    """The sets' hashes are gone from the shared folder before the whole sets are counted."""
    gone, seen = [], []
    monkeypatch.setattr(jaccard, "remove", lambda spark, path: (gone.append(path.rsplit("/", 1)[1].rsplit("-", 1)[0]), common.remove(spark, path)))
    census = jaccard.census
    monkeypatch.setattr(jaccard, "census", lambda *a, **k: (seen.append(list(gone)), census(*a, **k))[1])
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60 + i % 2))) for i in range(8)], "doc_id long, text string")
    assert {r.component_id for r in jaccard.near_duplicates(spark, docs).select(F.col("component_id")).collect()} == {0}
    assert seen == [["jaccard-sets"], ["jaccard-sets", "jaccard-classes"]]


def test_few_facts_take_few_exchanges(spark, monkeypatch):
    """While classes are few, the sets' joins broadcast them: less than two thirds of the jobs that dealing takes, whose results are the same."""
    draw = random.Random(3)
    texts = []
    for at in range(6):  # chains around a first text, its neighbours and theirs, with copies
        words = [f"w{at}-{j}" for j in range(60)]
        for step in range(7):
            texts += [" ".join(words)] * (1 + step % 2)
            words[draw.randrange(60)] = f"x{at}-{step}"
    texts += [" ".join(f"y{k}-{j}" for j in range(30)) for k in range(5)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    next_job = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in ((t or "").split() for t in texts)]
    least = list(range(len(texts)))
    for _ in texts:
        least = [min([least[k], *(least[j] for j, b in enumerate(sets) if a and b and 100 * len(a & b) >= 80 * len(a | b))]) for k, a in enumerate(sets)]
    jobs = []
    for most in (jaccard.FACTS, 0):
        monkeypatch.setattr(jaccard, "FACTS", most)
        monkeypatch.setattr(jaccard, "SHINGLES", most)
        began = next_job()
        found = jaccard.near_duplicates(spark, docs, 3, 80).collect()
        jobs.append(next_job() - began)
        assert {r.doc_id: r.component_id for r in found} == dict(enumerate(least))
    assert 3 * jobs[0] < 2 * jobs[1], jobs

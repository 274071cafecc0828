"""Operators 6, 8 and 9 against plain loops: folding, hits, exceptions, learned weights, features, fitting, single commits."""

import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm import pieces, quality, tokens, toxicity

from .test_operators import PIECES, prose

# ---- 6


def plain_folded(text):
    """Character by character: fold, then digits and signs by their neighbours, then words."""
    chars = []
    for c in text:
        for x in unicodedata.normalize("NFKD", c).lower():
            if not unicodedata.combining(x) and x not in toxicity.INVISIBLE:
                chars.append(toxicity.LOOKALIKES.get(x, x))
    out, i = [], 0
    while i < len(chars):
        j = i
        while j < len(chars) and chars[j] in toxicity.SUBSTITUTES:
            j += 1
        if j > i:
            run = chars[i:j]
            after, before = j < len(chars) and chars[j].isalpha(), i > 0 and chars[i - 1].isalpha()
            out += [toxicity.SUBSTITUTES[c] for c in run] if after or (before and not any(c in "!|+€" for c in run)) else run
            i = j
        else:
            out.append(chars[i])
            i += 1
    words, word = [], ""
    for c in [*out, " "]:
        if c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    return " " + " ".join(words) + " "


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="abzI ıіО0134578@$!|+€é\u0301\u200b_-.,ﬁＡ１ß\n", max_size=30))
def test_folding_equals_plain_loops(text):
    assert toxicity.folded(text) == plain_folded(text)


def plain_hits(text, lexicon):
    spans = [(i, i + len(p)) for p in lexicon.exceptions for i in range(len(text)) if text.startswith(p, i)]
    out = []
    for i in range(len(text)):
        best = None
        for entry in sorted((e for e in lexicon.weights if text.startswith(e, i)), key=len):
            if best is None or lexicon.weights[entry] > best[2]:
                best = (i, i + len(entry), lexicon.weights[entry])
        if best and not any(a <= i and best[1] <= b for a, b in spans):
            out.append(best)
    return out


def test_hits_and_exceptions_equal_plain_loops():
    rng = random.Random(2)
    vocabulary = ["grum", "grumb", "grumbl", "snar", "snarg", "mister", "my", "a", "old"]
    for _ in range(200):
        weights = {rng.choice([" {}", " {} "]).format(rng.choice(vocabulary)): rng.choice([1.0, 2.0, 2.0, 3.5]) for _ in range(rng.randint(0, 7))}
        phrases = sorted({" " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 3))) + " " for _ in range(rng.randint(0, 4))})
        lexicon = toxicity.Lexicon(weights, phrases)
        text = " " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 25))) + " "
        assert sorted(lexicon.hits(text, lexicon.automaton())) == sorted(plain_hits(text, lexicon)), (weights, phrases, text)


def test_hits_of_a_very_long_text_are_found_in_linear_time():
    lexicon = toxicity.Lexicon({" grum": 1.0}, [" mister grumblor "])
    text = " " + "mister grumblor grumb " * 60_000
    assert len(lexicon.hits(text, lexicon.automaton())) == 60_000


def plain_weights(rows):
    """The documented thresholds over counts by plain loops."""
    texts, times, words, docs = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}, Counter(), Counter()
    for text, y in rows:
        found = plain_folded(text or "").split()
        docs[y] += 1
        words[y] += len(found)
        mine = Counter()
        for w in found:
            mine[f" {w} "] += 1
            for k in range(toxicity.SHORTEST, min(len(w), toxicity.LONGEST) + 1):
                mine[f" {w[:k]}"] += 1
        texts[y].update(mine.keys())
        times[y].update(mine)
    share, passed = docs[1] / (docs[0] + docs[1]), {}
    for e in texts[1]:
        toxic, clean = texts[1][e], texts[0][e]
        part = toxic / (toxic + clean)
        odds = math.log((times[1][e] + 0.5) / words[1] * words[0] / (times[0][e] + 0.5))
        ratio = toxic * math.log(part / share) + (clean * math.log((1 - part) / (1 - share)) if clean else 0.0)
        if toxic >= toxicity.SUPPORT and part > share and ratio >= toxicity.RATIO and odds >= math.log(toxicity.TIMES):
            passed[e] = odds
    out = {}
    for e in sorted(passed, key=lambda e: (len(e.rstrip()), e)):
        if passed[e] > toxicity.MORE * max((out.get(e[:n], 0.0) for n in range(toxicity.SHORTEST + 1, len(e))), default=0.0):
            out[e] = passed[e]
    return out


def test_learned_lexicon_equals_plain_loops(spark):
    rng = random.Random(3)
    bad = ["grumblor", "grumblers", "snargle", "Gr0mf", "wretchedly"]
    rows = [(prose(i, 25) + (" " + " ".join(rng.choices(bad, k=2)) if i % 3 == 0 else "") + (" mister grumblor" if i % 30 == 10 else ""), int(i % 3 == 0)) for i in range(400)] + [(None, 0), ("", 1)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, label int").repartition(3))
    want = plain_weights(rows)
    assert lexicon.weights.keys() == want.keys() and want
    assert all(lexicon.weights[e] == pytest.approx(want[e]) for e in want)
    assert any("mister grumblor" in p for p in lexicon.exceptions)
    # The scale of scores is where the regularised log loss has no slope.
    a = lexicon.automaton()
    x = np.array([[*np.log1p(20 * np.array(lexicon.measures(t or "", a))), 1.0] for t, _ in rows])
    y = np.array([label for _, label in rows])
    weigh = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.array([*lexicon.slope, lexicon.bias])
    assert np.abs(x.T @ (weigh * (1 / (1 + np.exp(-x @ w)) - y)) + 1e-4 * w).max() < 1e-8
    assert lexicon.score(lexicon.measures(rows[0][0], a)) == pytest.approx(1 / (1 + math.exp(-float(x[0] @ w))))


# ---- 8


def part_of(*texts):
    return next(tokens.parts(pa.array(texts)))


def plain_features(text):
    data = text.encode()
    kinds = [0] * quality.KINDS
    for byte in data:
        c = chr(byte)
        kind = 11 if byte >= 128 else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == " " else 5 if c == "\n" else 6 if c in ".,;:'\"()-" else 7 if c in "!?" else 8 if c in "|<>{}[]=/\\" else 9 if c in "*#$%&@^~_+`" else 10 if c in "\t\r\v\f" else 0
        kinds[kind] += 1
    words = [w for w in data.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\v", b" ").replace(b"\f", b" ").split(b" ") if w]
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    hashed = [int(tokens.word_hashes(p := part_of(w.decode()), tokens.words(p))[0]) for w in low]
    slots = Counter(h % quality.SLOTS for h in hashed)
    n, size = len(words), len(data)
    statistics = [math.sqrt(k / max(size, 1)) for k in kinds]
    statistics += [math.log1p(size), math.log1p(n), sum(map(len, words)) / max(n, 1), len(set(low)) / max(n, 1), max(slots.values(), default=0) / max(n, 1), kinds[5] / max(math.log1p(n), 1), float(n == 0)]
    length = math.sqrt(sum(v * v for v in slots.values()))
    return statistics, {s: v / length for s, v in slots.items()}


TEXTS = ["", "one", "One two TWO\n\ntwo 3.5!", "é 日本 |x| *** $$$\t", prose(1, 40), prose(2, 300) + " a" * 50, " \n "]


def test_features_equal_plain_loops():
    for group in (TEXTS, *[[t] for t in TEXTS]):
        f = quality.features(part_of(*group))
        for i, t in enumerate(group):
            statistics, slots = plain_features(t)
            assert f.statistics[i] == pytest.approx(statistics)
            assert dict(zip(f.slot[f.doc == i].tolist(), f.value[f.doc == i].tolist(), strict=True)) == pytest.approx(slots)


def test_fitting_equals_plain_loops(monkeypatch):
    """AdaGrad on log loss, a document and a feature at a time; each batch's gradient is summed before a step."""
    monkeypatch.setattr(quality, "EPOCHS", 3)
    monkeypatch.setattr(quality, "BATCH", 5)
    rows = [(quality.features(part_of(prose(i, 8) + (" win $$$" if i % 3 == 0 else ""))), int(i % 3 != 0)) for i in range(17)]
    got = quality.fit(rows)
    m, rng = quality.SLOTS + quality.STATISTICS, np.random.default_rng(7)
    stats = np.array([f.statistics[0] for f, _ in rows])
    centre, scale = stats.mean(0), stats.std(0) + 1e-6
    factors = rng.normal(0, 0.02, (m, quality.RANK))
    weight, bias, sw, sv, sb = np.zeros(m), 0.0, np.full(m, 1e-2), np.full((m, quality.RANK), 1e-2), 1e-2
    y = [label for _, label in rows]
    weigh = [len(y) / (2 * sum(y)) if label else len(y) / (2 * (len(y) - sum(y))) for label in y]
    x = [dict(zip(f.slot.tolist(), f.value.tolist(), strict=True)) | {quality.SLOTS + k: float(np.clip((f.statistics[0][k] - centre[k]) / scale[k], -4, 4) / 4) for k in range(quality.STATISTICS)} for f, _ in rows]
    for _ in range(3):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 5):
            gw, gv, gb = Counter(), {}, 0.0
            for i in order[at : at + 5]:
                keys = list(x[i])
                pairs = sum(factors[a] @ factors[b] * x[i][a] * x[i][b] for n, a in enumerate(keys) for b in keys[:n])
                g = weigh[i] * (1 / (1 + math.exp(-(bias + sum(weight[a] * x[i][a] for a in keys) + pairs))) - y[i])
                total = sum(factors[a] * x[i][a] for a in keys)
                gb += g
                for a in keys:
                    gw[a] += g * x[i][a]
                    gv[a] = gv.get(a, np.zeros(quality.RANK)) + g * x[i][a] * (total - factors[a] * x[i][a])
            for a in gv:
                dw, dv = gw[a] + quality.DECAY * weight[a], gv[a] + quality.DECAY * factors[a]
                sw[a] += dw**2
                sv[a] += dv**2
                weight[a] -= quality.RATE * dw / math.sqrt(sw[a])
                factors[a] -= quality.RATE * dv / np.sqrt(sv[a])
            sb += gb**2
            bias -= quality.RATE * gb / math.sqrt(sb)
    assert got.bias == pytest.approx(bias) and np.allclose(got.weight, weight, atol=1e-9) and np.allclose(got.factors, factors, atol=1e-9)


def test_what_the_driver_holds_of_a_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows: (seen.append(sum(len(f.slot) for f, _ in rows)), fit(rows))[1])
    quality.train(docs, labels)
    monkeypatch.setattr(quality, "SAMPLE_SLOTS", seen[0] // 2)
    quality.train(docs, labels)
    assert seen[0] // 4 < seen[1] <= seen[0] // 2


# ---- 9


def test_words_are_streams_with_a_single_commit():
    """What `short` gives is what `stream` commits: of so short a text it commits all at once, at the end."""
    v = pieces.Vocabulary.read(PIECES)
    rng = random.Random(6)
    letters = [c for c in v.known if len(c) == 1 and c != "\n"][:60] + list("abcdefghijklmnopqrstuvwxyz ")
    words = [" " + w for t in (prose(1, 300), "internationalisation überraschend l'été ciónñ") for w in t.split()]
    words += ["".join(rng.choices(letters, k=rng.randint(1, 2 * v.longest))) for _ in range(2_000)]
    checked = 0
    for w in words:
        if len(w) <= 2 * v.longest and v.known.keys() >= set(w):
            commits = []
            pieces.stream(w, v, commits.append)
            assert len(commits) == 1 and commits[0] == pieces.short(w, v), w
            checked += 1
    assert checked > 1_500

"""Fill-in-middle against plain slicing, the rope against strings."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm import middle
from orrery.llm.rope import Rope

SCHEMA = "doc_id long, text string, n long, form string, output string, draws string, prefix_chars string"
TEXTS = [None, "", "\n", "one", "one\n", "\n\n\nx", "a\r\nb\rc\n", "日本\n語 😀\né", "has <P> in it\nand more", "<S>", "x<M>\n", "<\nP>\n<S\n>", "line\n" * 3000, "x" * 20_000, "<<P\nS>>\n<", "ends with <\n"]


def plain(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "rate", "spm_rate"), [(7, 100, 50), (1, 60, 30), (2, 0, 50), (3, 100, 100)])
def test_equals_plain_slicing(spark, seed, rate, spm_rate):
    rows = [(i if i else None, t, 1, "f", "o", "d", "p") for i, t in enumerate(TEXTS * 4)] + [(5, TEXTS[5], 1, "f", "o", "d", "p")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    made = middle.restore(middle.transform(df, seed, rate, spm_rate), "output").collect()
    assert sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r["output'"]) for r in made) == sorted((str(i), *(str(x) if k in (2, 3) else x for k, x in enumerate(plain(i, t, seed, rate, spm_rate))), t or "") for i, t, *_ in rows)
    if rate == 100 and spm_rate == 50:
        assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    made = middle.restore(middle.transform(spark.createDataFrame([], SCHEMA)))
    assert made.collect() == [] and made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


def test_only_forms_that_are_known_come_back():
    for output, form in (("no sentinel", "psm"), ("<P>a<S>b", "psm"), ("<P>a<S>b<M>c", "spm")):
        with pytest.raises(ValueError):
            middle.rebuilt(output, form)


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab\n<PSM>é😀", max_size=60), st.integers(1, 7), st.data())
def test_rope_cuts_like_a_string(text, leaf, data):
    rope, units = Rope.of(text, leaf), re.findall(r"[^\n]*\n|[^\n]+", text)
    assert (str(rope), rope.chars, rope.units) == (text, len(text), len(units))
    k, i = data.draw(st.integers(0, len(units))), data.draw(st.integers(0, len(text)))
    a, b = rope.at_unit(k)
    assert (str(a), str(b), a.units, b.units) == ("".join(units[:k]), "".join(units[k:]), k, len(units) - k)
    a, b = rope.at_char(i)
    assert (str(a), str(b), a.chars, b.chars) == (text[:i], text[i:], i, len(text) - i)
    both = Rope.joined(b, Rope("<M>"), a)
    assert str(both) == text[i:] + "<M>" + text[:i] and both.find("<M>") == str(both).find("<M>") and both.find("S>") == str(both).find("S>")


def test_a_cut_makes_few_nodes():
    text = "".join(random.Random(1).choice("ab\n") for _ in range(200_000))
    rope = Rope.of(text, 64)
    made = []
    keep = Rope.__init__
    try:
        Rope.__init__ = lambda self, *a, **b: (made.append(1), keep(self, *a, **b))[1]
        rope.at_unit(rope.units // 2)
    finally:
        Rope.__init__ = keep
    assert len(made) < 60

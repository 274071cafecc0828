"""Language identification: text likelihoods, declared markup language, address suffix and host priors, fused by Bayes' rule.

log P(language | row) = tempered log P(text | language) + log P(declared | language) + log P(suffix | language)
                        + log P(language | host), up to a constant.

One class stands for the languages that nobody labelled: in its texts all runs are equally likely. A labelled language beats
it only where the text has that language's runs more often than by chance, so confidence judges fit as well as rank.

The last three come from grouped sums, over all rows, of what the texts alone say. The host's prior is smoothed towards its
registered domain's and that towards the whole corpus', and leaves out what the row itself has added.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import few, in_arrow, table, written

#: Slots for hashed runs of three bytes; the bound of labelled rows for the text model; the weight of a long text in runs.
SLOTS, SAMPLE, RUNS = 1 << 15, 4_000, 60
#: Tasks that count the sample: each sends SLOTS sums a language to the driver.
TASKS = 8
#: Rows of its parent's prior that a host and a domain start with; pseudo-counts of a declared language or suffix.
STRENGTH, PSEUDO = 8.0, 0.5
#: The class of texts in none of the labelled languages; the least share of a language's mass that is spread over all slots.
UNKNOWN, SPREAD = "und", 0.1
#: Hosts with more than a LARGE-th of all rows: there are fewer than LARGE, so they are broadcast, and the others' join has no hot key.
LARGE = 1_000
#: Labels under which countries register names.
SECOND_LEVEL = "ac|co|com|edu|gov|net|org"
#: A row whose best language has less than this posterior is rejected.
CONFIDENCE = 0.5

_silent = re.compile(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible(markup: str) -> str:
    """The text of a page without scripts, styles, comments and tags."""
    return entities.unescape(_silent.sub(" ", markup))


def slots(part: tokens.Part) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of each run of three bytes inside a text, A-Z in lower case, anything but letters as one kind of gap."""
    data = _GAPS[part.data].astype(np.int64)
    doc = np.repeat(np.arange(part.docs), np.diff(part.bounds))
    if len(data) < 3:
        return doc[:0], data[:0]
    inside = (doc[2:] == doc[:-2]) & ((data[1:-1] != 32) | (data[2:] != 32))
    key = (data[:-2] * 961 + data[1:-1]) * 961 + data[2:]
    return doc[2:][inside], (key[inside] * 40_503 >> 7) & (SLOTS - 1)


def blocks(part: tokens.Part) -> Iterator[tokens.Part]:
    """The part, or a longer text in blocks that overlap by two bytes, so that each run of three is in one of them."""
    if part.docs > 1 or len(part.data) <= tokens.PART_BYTES:
        yield part
        return
    for at in range(0, len(part.data), tokens.PART_BYTES):
        data = part.data[at : at + tokens.PART_BYTES + 2]
        yield tokens.Part(data, np.array([0, len(data)]), part.rows)


_GAPS = tokens.LOWER.copy()
_GAPS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities [slot, language], from at most SAMPLE rows (text, lang) of least hash of their text.

    Among the languages is UNKNOWN, all slots of which are alike. Every other one spreads a share of its mass over all slots:
    the same, so runs that no language has favour none of them, but for those known from few runs, which spread more (as if
    SPREAD of each slot had been seen) and never as much as UNKNOWN. Of equal texts with several languages the first in the
    alphabet counts. Only sums over slots leave the executors. Rows without a
    language, or with UNKNOWN, teach nothing; without any other row UNKNOWN is the only language.
    """
    known = docs.select("text", "lang").filter((F.col("lang") != UNKNOWN) & F.col("text").isNotNull())
    picked = known.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(SAMPLE)
    sampled = known.join(F.broadcast(picked), F.xxhash64("text") == F.col("h"), "left_semi").groupBy("text").agg(F.min("lang").alias("lang")).coalesce(TASKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            for part in tokens.parts(b.column("text")):
                for block in blocks(part):
                    doc, slot = slots(block)
                    for lang in set(langs[part.rows]):
                        here = (langs[part.rows] == lang)[doc]
                        sums[lang] = sums.get(lang, 0) + np.bincount(slot[here], minlength=SLOTS)
        for lang, n in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([n.astype("<i8").tobytes()], pa.binary())], names=["lang", "counts"])

    rows = in_arrow(sampled, work, "lang string, counts binary").toPandas()
    langs = sorted({*rows["lang"], UNKNOWN})
    counts = np.zeros((SLOTS, len(langs)))
    for lang, n in zip(rows["lang"], rows["counts"], strict=True):
        counts[:, langs.index(lang)] += np.frombuffer(n, "<i8")
    total = counts.sum(0)
    spread = np.maximum(SPREAD, SPREAD * SLOTS / (SPREAD * SLOTS + total))
    return langs, np.log((1 - spread) * counts / np.maximum(total, 1) + spread / SLOTS).astype(np.float32)


def likelihoods(rows: DataFrame, langs: list[str], table_: np.ndarray, keep: list[str]) -> DataFrame:
    """Adds ll: for each language the mean log likelihood of the whole text's runs, times at most RUNS of them."""
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c in keep) + ", ll array<double>"
    names = [c for c in rows.columns if c in keep]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            if "is_markup" in b.schema.names:
                texts = pa.array([visible(t) if m and t else t for t, m in zip(texts.to_pylist(), b.column("is_markup").to_pylist(), strict=True)], pa.string())
            found = [np.zeros((0, len(langs)))]
            for part in tokens.parts(texts):
                n, sums = np.zeros(part.docs), np.zeros((part.docs, len(langs)))
                for block in blocks(part):
                    doc, slot = slots(block)
                    n += np.bincount(doc, minlength=part.docs)
                    sums += np.stack([np.bincount(doc, table_[slot, i], minlength=part.docs) for i in range(len(langs))], 1)
                found.append(sums / np.maximum(n, 1)[:, None] * np.minimum(n, RUNS)[:, None])
            ll = pa.ListArray.from_arrays(np.arange(0, b.num_rows * len(langs) + 1, len(langs), dtype=np.int32), np.concatenate(found).ravel())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), ll], names=[*names, "ll"])

    return in_arrow(rows, work, schema)


def softmax(ll: Column) -> Column:
    top = F.array_max(ll)
    parts = F.transform(ll, lambda x: F.exp(x - top))
    return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, y: a + y))


def registered(address: Column) -> Column:
    """The registered domain of a host name: its last two labels, or three under a country's second level; an address is its own."""
    found = F.regexp_extract("host", rf"([^.]+\.(?:(?:{SECOND_LEVEL})\.[a-z]{{2}}|[^.]+))$", 1)
    return F.when(address | (found == ""), F.col("host")).otherwise(found)


def identify(rows: DataFrame, labelled: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, lang, confidence and text_lang of every row of (keys, text, is_markup, declared, host).

    declared is a language tag or null, host a host name or null; either may be wrong. A null text counts as empty: then the
    other evidence decides, and without any the corpus' prior. Of equal posteriors the language first in the alphabet is
    taken. A text in none of the labelled languages has the language UNKNOWN. Repeated rows have equal results; an empty
    table gives no rows. Columns but these and `keys` are ignored; a key must not have the name of one of these.
    """
    spark = rows.sparkSession
    langs, logs = train(labelled)
    n = range(len(langs))
    host = F.lower(F.trim("host"))
    tag = F.regexp_extract(F.lower(F.coalesce("declared", F.lit(""))), "^([a-z]{2,3})(?:[-_]|$)", 1)
    made = rows.withColumns({"host": F.coalesce(host, F.lit("")), "declared": tag})
    address = F.col("host").rlike(r"^[0-9.]+$|[:\[\]]")
    made = made.withColumns({"suffix": F.when((F.instr("host", ".") > 0) & ~address, F.regexp_extract("host", r"([^.]+)$", 1)).otherwise(""), "domain": registered(address)})
    kept = [*keys, "host", "domain", "suffix", "declared"]
    evidence = written(spark, likelihoods(made, langs, logs, kept), "language-evidence")
    evidence = evidence.withColumn("alone", softmax(F.col("ll")))
    sums = [F.sum(F.get("alone", i)).alias(f"n{i}") for i in n]
    hosts = written(spark, evidence.groupBy("host", "domain").agg(*sums, F.count("*").alias("rows")), "language-hosts")
    *total, count = hosts.agg(*(F.sum(f"n{i}") for i in n), F.sum("rows")).first()
    whole = sum(x or 0 for x in total)
    prior = [((x or 0) + 1) / (whole + len(langs)) for x in total]
    hosts = hosts.filter("host <> ''")
    domains = hosts.groupBy("domain").agg(*(F.sum(f"n{i}").alias(f"d{i}") for i in n))
    hosts = hosts.join(domains, "domain").drop("domain")
    large = hosts.filter(F.col("rows") * LARGE > F.lit(count or 0)).drop("rows")
    names = [c for c in large.columns if c != "host"]
    placed = evidence.join(F.broadcast(large), "host", "left")
    # A row of a large host, or of none, is done; the others' hosts are many and none is hot.
    rest = (F.col("host") != "") & F.col("n0").isNull()
    small = placed.filter(rest).drop(*names).join(hosts.drop("rows"), "host", "left")
    placed = placed.filter(~rest).unionByName(small)

    def given(column: str) -> DataFrame:
        """log P(value | language) for each value of a column that has few (tags and suffixes); an empty value says nothing."""
        found = evidence.filter(F.col(column) != "").groupBy(column).agg(*sums)
        all_ = found.agg(F.count("*"), *(F.sum(f"n{i}") for i in n)).first()
        return found.select(column, *(F.log((F.col(f"n{i}") + PSEUDO) / ((all_[i + 1] or 0) + PSEUDO * (all_[0] + 1))).alias(f"{column}_{i}") for i in n))

    joined = placed.join(few(given("declared")), "declared", "left").join(few(given("suffix")), "suffix", "left")
    # The domain's and the host's sums without this row's own share.
    domain_rows = sum((F.col(f"d{i}") for i in n), F.lit(0.0)) - 1
    host_rows = sum((F.col(f"n{i}") for i in n), F.lit(0.0)) - 1
    scores = []
    for i in n:
        own = F.get("alone", i)
        domain = (F.greatest(F.col(f"d{i}") - own, F.lit(0.0)) + STRENGTH * prior[i]) / (domain_rows + STRENGTH)
        from_host = F.log((F.greatest(F.col(f"n{i}") - own, F.lit(0.0)) + STRENGTH * domain) / (host_rows + STRENGTH))
        of_host = F.when(F.col("host") == "", math.log(prior[i])).otherwise(from_host)
        scores.append(F.get("ll", i) + F.coalesce(f"declared_{i}", F.lit(0.0)) + F.coalesce(f"suffix_{i}", F.lit(0.0)) + of_host)
    spoken = F.array(*map(F.lit, langs))
    best = lambda p: F.get(spoken, F.array_position(p, F.array_max(p)).cast("int") - 1)
    out = joined.select(*keys, softmax(F.array(*scores)).alias("posterior"), "alone")
    return out.select(*keys, best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("confidence"), best(F.col("alone")).alias("text_lang"))


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows for `identify`: their source stands for the host; they declare nothing."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text", F.lit(False).alias("is_markup"), F.lit(None).cast("string").alias("declared"), F.col("source").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows for `identify`: the html element's lang attribute and the address' host."""
    declared = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1)
    host = F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), F.col("html").alias("text"), F.lit(True).alias("is_markup"), declared.alias("declared"), F.when(host != "", host).alias("host"))


def rejected(docs: DataFrame, labelled: DataFrame, least: float = CONFIDENCE) -> DataFrame:
    """doc_id of rows of `docs` in no labelled language, or whose best one has a posterior below `least`, or without a letter to judge by."""
    found = identify(of_documents(docs.withColumn("source", F.col("source").cast("string"))), labelled, ["doc_id"]).filter((F.col("confidence") < least) | (F.col("lang") == UNKNOWN)).select("doc_id")
    return found.union(docs.filter(~F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))).select(F.col("doc_id").cast("long")))


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents (doc_id) and of all pages (page_id)."""
    docs = table(spark, sf_dir, "documents")
    rows = of_documents(docs).unionByName(of_pages(table(spark, sf_dir, "pages")))
    return identify(rows, docs, ["doc_id", "page_id"])

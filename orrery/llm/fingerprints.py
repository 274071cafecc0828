"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits, in SQL functions alone.

The words of a text are hashed once, five neighbouring hashes make a shingle's, and a shingle falls into the bin of its hash's
top bits. A bin keeps its least hash. An empty bin takes the value of another one, found by a sequence of probes that is the
same for all documents and random for each bin, so equal sets stay equal and two documents agree in a borrowed bin with the
probability of their likeness. Of each bin's value the low bits are kept, packed as hexadecimal digits.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, table, written

#: Words of a shingle, bins (a power of two), bits kept of each bin (4 or 8), probes before the exhaustive choice.
WIDTH, BINS, BITS, PROBES = 5, 128, 8, 8

def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs of `width` words, A-Z in lower case; fewer words are one run, a text without words has none."""
    words = F.filter(F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        return F.when(F.size(h) >= width, many).when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))).otherwise(F.array().cast("array<long>"))

    return F.get(F.transform(F.array(hashes), runs), 0)


def probes(bins: int, n: int) -> list[list[int]]:
    """For each bin the first n of a random order of all bins, from a fixed seed."""
    rng = random.Random(20_170_612)
    return [rng.sample(range(bins), n) for _ in range(bins)]


def densified(h: Column, bins: int = BINS, n: int = PROBES) -> Column:
    """The bins' values: each one's least hash, or that of the first of its probes that has any, or the one of least priority.

    Probes without repetition go through the bins in a random order of the bin's own; after `n` of them the order goes on by
    the hash of (bin, other bin), over the filled ones. Without any shingle the array is empty.
    """
    bits = bins.bit_length() - 1
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - bits).cast("int")
    orders = F.array(*[F.array(*map(F.lit, p)) for p in probes(bins, n)])

    def mins(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    def dense(m: Column) -> Column:
        by_bin = F.map_from_arrays(F.transform(m, bin_of), m)

        def fill(at: Column) -> Column:
            def borrowed(b: Column) -> Column:
                order = F.get(orders, b)
                rest = F.array_min(F.transform(m, lambda x: F.struct(F.xxhash64(b, bin_of(x)).alias("priority"), x.alias("value"))))["value"]
                return F.coalesce(F.element_at(at, b), *[F.element_at(at, F.get(order, F.lit(k))) for k in range(n)], rest)

            return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), borrowed)

        # Longs are sorted as signed: the upper half of the bins comes first.
        turned = F.concat(F.slice(m, bins // 2 + 1, bins // 2), F.slice(m, 1, bins // 2))
        return F.when(F.size(m) == bins, turned).otherwise(F.get(F.transform(F.array(by_bin), fill), 0))

    sparse = F.get(F.transform(F.array(F.sort_array(h)), mins), 0)
    return F.get(F.transform(F.array(sparse), lambda m: F.when(F.size(m) == 0, m).otherwise(dense(m))), 0)


def fingerprint(text: Column, width: int = WIDTH, bins: int = BINS, bits: int = BITS) -> Column:
    """bins * bits / 4 hexadecimal digits; the empty string for a text without words."""
    low = lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit((1 << bits) - 1)))), bits // 4, "0")
    return F.array_join(F.transform(densified(shingles(text, width), bins), low), "")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated Jaccard similarity of two fingerprints, 0 to 1.

    Values that differ share their low bits with probability 2^-bits; that bias is taken off the share of equal bins. Two
    texts without words are alike (1), a text without words and one with words are not (0).
    """
    digits, chance = bits // 4, 0.5**bits
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.substr(a, i * digits + 1, F.lit(digits)) == F.substr(b, i * digits + 1, F.lit(digits))))
    corrected = F.greatest(F.lit(0.0), (same / F.lit(float(bins)) - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


#: What tells documents apart: rows that agree in both are one document repeated.
KEY = ["id", "hash"]


def precursors(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """For each document (id, hash) the one whose next document it is: its key (to_id, to_hash) and `half` of its characters.

    The next document is that in descending id, texts' hashes telling apart documents of one id; after the last comes the
    first. Only keys and lengths are sorted and numbered, no texts.
    """
    keys = rows.select(*KEY, "n_chars").distinct()
    ranked = written(spark, numbered(spark, keys, [F.desc("id"), "hash"], "fingerprint-keys"), "fingerprint-order")
    count = ranked.count()
    before = ranked.select(((F.col("number") + 1) % F.lit(max(1, count))).alias("number"), F.col("id").alias("to_id"), F.col("hash").alias("to_hash"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    return ranked.join(before, "number").select(*KEY, "to_id", "to_hash", "half")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_doc_id of every row.

    Null texts count as empty; an empty text and its edited text have the empty fingerprint and are alike. Rows without a
    doc_id come last. Rows that repeat both doc_id and text are one document and have equal results, its next document being
    the next other one; a single document is its own. Other columns are ignored; an empty table gives no rows.

    Texts are dealt once, by a hash of their key. What a document's precursor needs of it is sent there: its fingerprint, and
    no more characters than the precursor replaces.
    """
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    named = named.withColumns({"id": F.coalesce("doc_id", F.lit(-(1 << 63))), "hash": F.xxhash64("text")})
    before = precursors(spark, named.withColumn("n_chars", F.length("text").cast("long")))
    rows = named.withColumn("fingerprint", fingerprint(F.col("text")))
    sent = rows.join(before, KEY).select(F.col("to_id").alias("id"), F.col("to_hash").alias("hash"), F.substr("text", F.lit(1), F.col("half")).alias("beginning"), F.col("fingerprint").alias("next_fingerprint"), F.col("doc_id").alias("next_doc_id"))
    found = rows.join(sent.groupBy(*KEY).agg(*(F.first(c).alias(c) for c in ("beginning", "next_fingerprint", "next_doc_id"))), KEY)
    found = found.withColumn("edited", edited(F.col("text"), F.col("beginning")))
    found = found.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint", "next_doc_id")
    near = {"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"))}
    return found.withColumns(near).drop("next_fingerprint")


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of the following text, or of its beginning."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))

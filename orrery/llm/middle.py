"""Fill-in-middle: a text's lines are cut at two ranks and rearranged around sentinels; the text comes back from the output alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, table, unused
from .rope import Rope

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50


def rearranged(text: str, draws: tuple[int, int, int, int], rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, int | None, int | None, Rope]:
    """Units, form, code points of prefix and middle (None if plain), and the output as a rope."""
    rope = Rope.of(text)
    n = rope.units
    if not text or draws[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, rope
    first, second = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    head, suffix = rope.at_unit(second)
    prefix, middle = head.at_unit(first)
    p, s, m = Rope(PREFIX), Rope(SUFFIX), Rope(MIDDLE)
    spm = draws[3] % 100 < spm_rate
    out = Rope.joined(s, suffix, p, prefix, m, middle) if spm else Rope.joined(p, prefix, s, suffix, m, middle)
    return n, "spm" if spm else "psm", prefix.chars, middle.chars, out


def rebuilt(output: str, form: str) -> Rope:
    """The text that an output of this form was made from.

    A text with a sentinel in it stays plain, and no sentinel can arise where pieces meet, as each begins with the one `<` and
    ends with the one `>` that it has. So the first of each kind is the one that was set.
    """
    rope = Rope.of(output)
    if form == "plain":
        return rope
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if not output.startswith(first):
        raise ValueError(f"an output of form {form} begins with {first}")
    _, rope = rope.at_char(len(first))
    parts = []
    for mark in (second, MIDDLE):
        at = rope.find(mark)
        if at < 0:
            raise ValueError(f"an output of form {form} has {mark}")
        part, rope = rope.at_char(at)
        parts.append(part)
        _, rope = rope.at_char(len(mark))
    prefix, suffix = parts[::-1] if form == "spm" else parts
    return Rope.joined(prefix, rope, suffix)


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row.

    What is drawn for a row depends on its doc_id and the seed alone: sha256 of `seed:doc_id`, with nothing for a null doc_id.
    So rows that repeat a doc_id are cut at ranks of the same draws. Of 100 documents about `rate` are rearranged, and of these
    about `spm_rate` have the suffix first. Null texts count as empty; those and texts with a sentinel are plain. Whole texts
    are rearranged, whatever their length. Other columns are ignored; an empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), draws.alias("draws"))
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [rearranged(t, d, rate, spm_rate) for t, d in zip(b["text"].to_pylist(), b["draws"].to_pylist(), strict=True)]
            n, form, prefix, middle, out = zip(*made, strict=True) if made else ((),) * 5
            numbers = [pa.array(x, pa.int64()) for x in (n, prefix, middle)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], numbers[0], pa.array(form, pa.string()), *numbers[1:], pa.array(map(str, out), pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return in_arrow(rows, work, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(made: DataFrame, name: str = "restored") -> DataFrame:
    """Adds the exact text that each row's `output` and `form` were made from, as `name` (with marks after it where it is taken)."""
    name = unused(made.columns, name)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [str(rebuilt(o, f)) for o, f in zip(b["output"].to_pylist(), b["form"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, name])

    return in_arrow(made, work, made.withColumn(name, F.lit("")).schema)


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle outputs of all documents, as digests, and the digests of the texts rebuilt from them."""
    made = restore(transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))

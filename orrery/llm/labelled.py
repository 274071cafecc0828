"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """The part of `n` in which a document is: crc32 of its doc_id as text."""
    return F.crc32(doc_id.cast("string")) % n


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int, tasks: int = 16) -> DataFrame:
    """text and label of at most `most` labelled rows that are not held out, half of either label where there are as many.

    Of repeated labels of a document the mean counts; null labels and ids are passed over. The rows are those of least hash
    of doc_id, so the sample depends on the labels alone. Of documents that repeat a doc_id the one of least text is taken.
    `most` is a bound: the sample can be sent to the driver. It is dealt over `tasks` partitions.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    half = [known.filter(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for x in (0, 1)]
    found = docs.select("doc_id", "text").join(F.broadcast(half[0].unionByName(half[1])), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).repartition(tasks, "doc_id").select("text", "label")

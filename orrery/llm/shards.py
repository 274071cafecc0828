"""Sharding by longest processing time: groups of equal texts, largest first, each to the shard with the least load so far.

Groups of one size are alike to the schedule, so the driver deals a histogram of sizes: for each size, largest first, the
loads say how many of its groups each shard gets. The groups of a size are numbered on the executors and take the shards in
that order. The loads are those that scheduling group by group gives; what the driver holds are the distinct sizes.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_dealt, numbered, table, written

SHARDS = 24


def dealt(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` items of one size each shard gets, item by item the one of least load (then of least number); adds them to `loads`.

    An item lands on load L of its shard; the items are the `count` least (L, shard) of all. So all that lie below a level
    that holds no more than `count` are given at once, and a heap of loads deals the few that are left.
    """
    given = lambda level: [max(0, -(-(level - x) // size)) for x in loads]
    low, high = min(loads), max(loads) + size * (count // len(loads) + 1)
    while low < high:  # the highest level below which at most `count` items are
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(given(middle)) <= count else (low, middle - 1)
    out = given(low)
    heap = [(x + size * n, s) for s, (x, n) in enumerate(zip(loads, out, strict=True))]
    heapq.heapify(heap)
    for _ in range(count - sum(out)):
        load, shard = heap[0]
        out[shard] += 1
        heapq.heapreplace(heap, (load + size, shard))
    for s, n in enumerate(out):
        loads[s] += size * n
    return out


def lpt(histogram: list[tuple[int, int]], shards: int) -> tuple[list[list[int]], list[int]]:
    """For each (size, count) how many of its items each shard gets, and the loads: sizes in descending order, through a heap.

    The largest and the least load differ by at most the largest item; no shards is an error, no items give an empty list.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    loads, out = [0] * shards, [[0] * shards for _ in histogram]
    for i in sorted(range(len(histogram)), key=lambda i: -histogram[i][0]):
        out[i] = dealt(loads, *histogram[i])
    return out, loads


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the text's sha256, and a number of its own for each row. A null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("row"))


def assign(spark: SparkSession, found: DataFrame, shards: int) -> DataFrame:
    """Adds `shard` to digests. Equal texts get one shard; the groups of one size take their shards in the order of digests.

    The driver collects the histogram of group sizes. Distinct sizes can't sum to more than the input, so there are at most
    sqrt(2 * bytes) of them, and as a rule as many as a text has lengths.
    """
    groups = found.groupBy("digest").agg(F.sum("size").alias("bytes"))
    groups = numbered(spark, groups, ["digest"], "shard-groups", within="bytes")
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("groups")).toPandas()
    given, _ = lpt(list(zip(sizes["bytes"].tolist(), sizes["groups"].tolist(), strict=True)), shards)
    plan = [(b, s, n) for b, each in zip(sizes["bytes"].tolist(), given, strict=True) for s, n in enumerate(each) if n]
    frame = pd.DataFrame(plan, columns=["bytes", "shard", "n"])
    # The groups of a size with numbers from `first` on go to `shard`: groups that share a shard lie side by side.
    frame["first"] = frame.groupby("bytes")["n"].cumsum() - frame["n"] if len(frame) else 0
    ranges = spark.createDataFrame(frame.astype("int64"), "bytes long, shard long, n long, first long").groupBy("bytes").agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("ranges"))
    at = F.filter("ranges", lambda r: r["first"] <= F.col("number"))
    placed = join_dealt(groups, ranges, ["bytes"], groups.count(), by=F.col("number")).select("digest", F.element_at(at, -1)["shard"].cast("int").alias("shard"))
    return join_dealt(found, placed, ["digest"], found.count(), by=F.col("row"))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, under the law `bytes`.

    A row's size is its text's UTF-8 bytes plus 8; a null text counts as empty, and null and empty texts are one group.
    Repeated rows each get a slot; slots follow doc_id (nulls first), then the text's digest. Other columns are ignored;
    an empty table gives no rows. A single group larger than a shard's share stays together, as groups must.
    """
    found = written(spark, digests(docs), "shard-digests")
    out = numbered(spark, assign(spark, found, shards), ["doc_id", "digest", "row"], "shard-slots", within="shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("number").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placement: DataFrame, folder: str) -> None:
    """Writes the documents with their shard and slot as Parquet, a folder for each shard. doc_id must be unique here."""
    docs.join(placement.select("doc_id", "shard", "slot"), "doc_id").write.partitionBy("shard").parquet(folder)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    return shard_documents(spark, table(spark, sf_dir, "documents"))

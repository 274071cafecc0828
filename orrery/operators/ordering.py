"""Global order without a task that has all rows: range partitions, sorted, and the number of rows in those before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written


def numbered(df: DataFrame, order: list[str | Column], first: int = 1) -> DataFrame:
    """Adds `number`, gapless from `first` in the given order; rows that tie are numbered in some order.

    Rows are written once, range-partitioned and sorted, each with its place in its partition. The driver gets a count for each
    partition, no rows; the sums of those before come back as a table of as many rows.
    """
    spark = df.sparkSession
    rows = written(spark, df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumns({"part": F.shiftright("place", 33).cast("int"), "place": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = sorted((r.part, r.n) for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect())
    shifts, total = [], first
    for part, n in counts:
        shifts.append((part, total))
        total += n
    before = spark.createDataFrame(shifts, "part int, shift long")
    return rows.join(F.broadcast(before), "part").withColumn("number", F.col("place") + F.col("shift")).drop("part", "place", "shift")

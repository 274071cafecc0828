"""What the training-data operators share: the shared folder, written tables, Arrow batches, numbering and atomic files."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Bytes of rows that a Python worker gets at once, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of a side that may be broadcast; beyond that it is joined by a shuffle.
BROADCAST_ROWS = 200_000
#: A key is hot that more rows have than HOT_ROWS and than one in HOT_KEYS of all; so there are fewer hot keys than HOT_KEYS.
HOT_ROWS, HOT_KEYS = 100, 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session's configuration names it, in the default file system.

    Only in local mode, where there is one machine, a folder of our own is made where the setting is absent.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get("orrery.shared.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='orrery-')}"
        spark.conf.set("orrery.shared.dir", named)
        context.setCheckpointDir(named)
    path = context._jvm.org.apache.hadoop.fs.Path(named)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", found)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver's interpreter ends."""
    path = f"{shared_dir(spark)}/orrery/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of any store that Spark reaches; nothing happens once the session has ended."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes `df` as Parquet in the shared folder and returns a reader of it."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Gives freed memory back to the system, as an idle worker keeps what it once had."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """`df.mapInArrow`, for batches of at most BATCH_BYTES (or one row), whose workers give their memory back at a task's end.

    Arrow keeps every column's values as they are: integers beside nulls stay integers, other columns pass untouched.
    """
    spark = df.sparkSession
    if _bytes(spark.conf.get(BATCH_SETTING, None)) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return df.mapInArrow(released, schema)


def _bytes(text: str | None) -> float:
    """A size of Spark's settings; none, or one below 1, means no limit."""
    m = re.fullmatch(r"(?i)(-?\d+)([bkmg]?)b?", text or "")
    return int(m[1]) << {"k": 10, "m": 20, "g": 30}.get(m[2].lower(), 0) if m and int(m[1]) > 0 else float("inf")


class Recent(dict):
    """Packed ids of texts that are looked up, or else made. What isn't met while one generation of about `most` bytes fills is forgotten when the next is full."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.held, self.old = make, most, 0, {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= 64:
            self.held += 150 + len(text) + len(found)
            if self.held > self.most:
                self.old, self.held = dict(self), 0
                self.clear()
            self[text] = found
        return found

    def shrink(self, most: int) -> None:
        """Forgets the old generation, and the new one where it is larger than `most` bytes."""
        self.old = {}
        if self.held > most:
            self.clear()
            self.held = 0


def unused(columns: list[str], name: str) -> str:
    """`name`, with as many marks after it as no column has; Spark doesn't tell upper from lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "'"
    return name


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast while it has at most `most` rows; a larger one stays as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def join_dealt(rows: DataFrame, facts: DataFrame, on: list[str], total: int, how: str = "inner", by: Column | None = None, counts: DataFrame | None = None) -> DataFrame:
    """`rows.join(facts, on, how)`, an inner or left join, where very many rows may have one key and facts have each key once.

    The rows of a hot key are dealt by `by` (by default a hash of the row) over copies of its fact, one for as many rows as make
    a key hot. `total` is the number of rows; `counts` has those of each key as `count`, where they are known. Only the hot
    keys are broadcast, fewer than HOT_KEYS at any size; copies are no more than total / HOT_ROWS, and one a key. Rows of a null key match nothing.
    """
    most = max(HOT_ROWS, total // HOT_KEYS)
    copies, copy = (unused([*rows.columns, *facts.columns], name) for name in ("copies", "copy"))
    counts = rows.groupBy(*on).count() if counts is None else counts
    hot = F.broadcast(counts.filter(F.col("count") > most).select(*on, F.ceil(F.col("count") / most).alias(copies)))
    number = F.coalesce(F.col(copies), F.lit(1))
    left = rows.withColumn(copy, by if by is not None else F.xxhash64(*rows.columns)).join(hot, on, "left").withColumn(copy, F.pmod(F.col(copy), number)).drop(copies)
    right = facts.join(hot, on, "left").withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), number - 1))).drop(copies)
    return left.join(right, [*on, copy], how).drop(copy)


def numbered(spark: SparkSession, df: DataFrame, order: list[str | Column], name: str, within: str | None = None) -> DataFrame:
    """`df` with `number`, gapless from 0 (in each value of the column `within`) in the given order; nothing is gathered in one task.

    Rows are range-partitioned and sorted; a row's place in its partition, written beside it, plus the rows of earlier
    partitions is its number. What is summed has a row for each partition and value of `within` in it. Equal rows may be dealt
    over partitions, so a key that very many rows share is no obstacle where `order` tells them apart.
    """
    by = [*([within] if within else []), *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = written(spark, rows.withColumn("place", F.monotonically_increasing_id()), name).withColumn("part", F.shiftright("place", 33))
    keys = [within, "part"] if within else ["part"]
    parts = rows.groupBy(*keys).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    if within:
        before = F.sum("n").over(Window.partitionBy(within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        parts = parts.withColumn("before", F.coalesce(before, F.lit(0)))
    else:
        parts = with_sums_before(written(spark, parts, f"{name}-parts"), "part", "n", "before")
    parts = parts.select(*keys, (F.col("before") - F.col("first")).alias("shift"))
    return rows.join(few(parts), keys).withColumn("number", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def with_sums_before(df: DataFrame, at: str, value: str, name: str, block: int = 4_096) -> DataFrame:
    """Adds the sum of `value` over rows of smaller `at` (unique long numbers from 0): sums of blocks, then within each block."""
    rows = df.withColumn("block", F.floor(F.col(at) / block).cast("long"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(F.sum(value).alias("of block"))
    blocks = blocks.select("block", F.coalesce(F.sum("of block").over(earlier(Window.orderBy("block"))), F.lit(0)).alias("of blocks"))
    inside = F.coalesce(F.sum(value).over(earlier(Window.partitionBy("block").orderBy(at))), F.lit(0))
    return rows.withColumn("inside", inside).join(blocks, "block").withColumn(name, (F.col("inside") + F.col("of blocks")).cast("long")).drop("block", "inside", "of blocks")


def write_atomically(folder: str, name: str, content: bytes) -> str:
    """Writes a file under a name of this attempt and renames it, so that a retried or doubled task leaves one whole file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder))  # Hadoop's names of one kind of store
    store.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        out.write(content)
    try:
        store.move(attempt, f"{path}/{name}")
    except OSError:  # stores whose rename doesn't replace: an earlier attempt has left the same content
        if store.get_file_info(f"{path}/{name}").type != fs.FileType.File:
            raise
        store.delete_file(attempt)
    return f"{folder}/{name}"

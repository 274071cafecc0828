"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Bytes of rows that a Python worker gets at once, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`df.mapInArrow`, for batches of at most BATCH_BYTES (or one row), whose workers give their memory back at a task's end."""
    conf = df.sparkSession.conf
    m = re.fullmatch(r"(?i)(\d+)([kmg]?)b?", conf.get(BATCH_SETTING, None) or "")
    if not m or not 0 < int(m[1]) << {"k": 10, "m": 20, "g": 30}.get(m[2].lower(), 0) <= BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return df.mapInArrow(released, schema)


def folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; without it, and in local mode alone, one of our own."""
    context = spark.sparkContext
    named = context.getConf().get(SETTING) or spark.conf.get("orrery.engine.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='orrery-engine-')}"
        spark.conf.set("orrery.engine.dir", named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path there; what is written to it goes when the driver's interpreter ends."""
    path = f"{folder(spark)}/engine/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

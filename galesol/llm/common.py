"""Shared helpers: session settings, tables that cut lineage, size-checked joins."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

#: Rows of an Arrow batch. A batch of whole texts stays small even when texts are long.
ARROW_ROWS = 512
#: Rows of an Arrow batch of numbers only.
NUMBER_ROWS = 1 << 15
#: Most numbers that travel with a task's function.
BROADCAST_ROWS = 500_000
#: Whether the shuffle files of an execution are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The setting for rows of an Arrow batch.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Most bytes of a side that is broadcast; a larger side is shuffled instead.
BROADCAST_BYTES = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Set what every operator here relies on; safe to call again."""
    spark.conf.set(BATCH, str(ARROW_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a local one only where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (root or "/tmp/galesol-shared").rstrip("/")


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    The shuffle files of the write go when it ends, since nothing reads them again. rows: of an Arrow batch, if not as set."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/galesol-{uuid.uuid4().hex}"
    during = {CLEANUP: "true"} | ({BATCH: str(rows)} if rows else {})
    before = {key: spark.conf.get(key) for key in during}
    try:
        for key, value in during.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by stored() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _width(kind: DataType) -> int:
    return sum(_width(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else 8


def small_side(df: DataFrame) -> DataFrame:
    """Hint a broadcast of a stored table only if its summed bytes are within BROADCAST_BYTES; else leave a shuffle join.

    Strings count by their bytes, arrays by their elements."""
    size = F.lit(16)
    for f in df.schema:
        if isinstance(f.dataType, ArrayType):
            size = size + 16 + F.coalesce(F.greatest(F.size(f.name), F.lit(0)), F.lit(0)) * _width(f.dataType.elementType)
        elif isinstance(f.dataType, StringType):
            size = size + 16 + F.coalesce(F.octet_length(f.name), F.lit(0))
        else:
            size = size + _width(f.dataType)
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def sized_groups(spark: SparkSession) -> int:
    """Number of partitions for a shuffle that this package asks for by name."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps from task to task. Functions travel by value, so no module of this package lives there to hold it."""
    kept = sys.modules.setdefault("galesol_worker", types.ModuleType("galesol_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]

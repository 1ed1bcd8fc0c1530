"""Grid tables laid out by cell, so that joins and aggregations by cell read them without an exchange."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from galesol.sources.catalog import shared_path

#: Whether a join may use a layout by some of its keys only (cell, of cell and time).
_SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"


def lay_out(df: DataFrame, buckets: int, by: list[str], order: list[str], path: str | None = None, name: str | None = None) -> DataFrame:
    """`df` stored in `buckets` buckets of `by`, in order within each, and read back.

    Tables that are to meet without an exchange need equal `by` and `buckets`, or numbers of buckets of which one divides the other.
    The rows are dealt out once, here. Every cell of a grid has as many rows as any other, so buckets are even."""
    spark = df.sparkSession
    name = name or f"laid_{uuid.uuid4().hex}"
    at = path or shared_path(spark, "laid")
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by, *order).option("path", at).format("parquet").mode("overwrite").saveAsTable(name)
    return spark.table(name)


@contextmanager
def joined_by_cell(spark: SparkSession) -> Iterator[None]:
    """Within it, plans may join by cell and time what is laid out by cell. A plan is settled when it is first asked for, by an action or explain."""
    before = spark.conf.get(_SUBSET)
    spark.conf.set(_SUBSET, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET, before)

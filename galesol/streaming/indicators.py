"""Indicators on Structured Streaming. Event time needs TIMESTAMP; late rows beyond a day go and are restored by a batch rerun of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galesol.functions.wind import capacity_factor
from galesol.operators.histogram import bin_of
from galesol.sources.catalog import shared_path

DELAY = "1 day"


def read_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A file stream over one of the folder's Parquet tables."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{folder}/{table}.parquet*")


#: State store of processors with timers.
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, name: str, partition_by: list[str] | None = None, folder: str | None = None, timers: bool = False) -> DataFrame:
    """Process what is there now into an append-only Parquet sink; returns all that was written.

    folder: holds the sink and its state, so that a later run goes on where the last one ended; a new shared one if not given.
    timers: keep state in RocksDB, which processors with timers need."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    out = folder or shared_path(spark, name)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if timers:
        spark.conf.set(PROVIDER, ROCKSDB)
    try:
        writer.start(f"{out}/data").awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def _by_day(stream: DataFrame, keys: list, aggregates: list[Column], delay: str) -> DataFrame:
    days = stream.withWatermark("time", delay).groupBy(F.window("time", "1 day").alias("w"), *keys)
    out = days.agg(*aggregates)
    return out.withColumn("day", F.col("w.start").cast("date")).drop("w")


def stream_daily_stats(stream: DataFrame, value: str, keys: list[str], delay: str = DELAY) -> DataFrame:
    v = F.col(value)
    return _by_day(stream, keys, [F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min")], delay)


def stream_event_counts(stream: DataFrame, value: str, keys: list[str], high: float = 25.0, low: float = 3.0, delay: str = DELAY) -> DataFrame:
    count = lambda hit, name: F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(name)
    return _by_day(stream, keys, [count(F.col(value) > high, "n_high"), count(F.col(value) < low, "n_low")], delay)


def stream_histogram(stream: DataFrame, value: str, keys: list[str], bins: int, delay: str = DELAY) -> DataFrame:
    """Daily partial counts of a value in [0, 1]; counts of days add up to those of any longer period."""
    rows = stream.where(F.col(value).between(0.0, 1.0)).withColumn("bin", bin_of(F.col(value), F.lit(0.0), F.lit(1.0), bins))
    return _by_day(rows, [*keys, "bin"], [F.count(F.lit(1)).alias("count")], delay)


def monthly(daily_counts: DataFrame, keys: list[str]) -> DataFrame:
    """Batch roll-up of daily partial counts."""
    return daily_counts.groupBy(*keys, "bin", F.trunc("day", "month").alias("month")).agg(F.sum("count").cast("long").alias("count"))


def stream_capacity_factor(stream: DataFrame, iec_class: str) -> DataFrame:
    """Stateless: the batch expression on a stream."""
    return stream.withColumn("cf", capacity_factor(F.col("ws"), iec_class))


def stream_masked_event_counts(stream: DataFrame, mask: DataFrame, value: str, keys: list[str], cell: list[str], high: float = 25.0, low: float = 3.0, delay: str = DELAY) -> DataFrame:
    """Daily event counts of unmasked cells only. mask: cell columns, mask and version, a stored version of a side table (catalog.read_version); its version goes with the counts.

    The mask is fixed for a run; a later run of the same stream may take a newer one."""
    land = mask.where("mask > 0.5").select(*cell, "version")
    return stream_event_counts(stream.join(land, cell), value, [*keys, "version"], high, low, delay)


def stream_departure(stream: DataFrame, clim: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Stateless: each row's departure from a stored climatology (keys, month, dom, base); 29 February has none and goes."""
    rows = stream.withColumn("month", F.month("time")).withColumn("dom", F.dayofmonth("time"))
    return rows.join(clim, [*keys, "month", "dom"]).withColumn("departure", F.col(value) - F.col("base")).drop("month", "dom")


def stream_raw_by_week(stream: DataFrame) -> DataFrame:
    return stream.withColumn("week", F.date_add(F.trunc(F.col("time").cast("date"), "week"), 6))

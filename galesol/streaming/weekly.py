"""Weeks from days: a day's window feeds a week's, and a week is published when it closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.sources.catalog import shared_path
from galesol.streaming.indicators import DELAY

#: Windows of seven days count from 1 January 1970, a Thursday; weeks begin on Monday.
MONDAY = "4 days"


def stream_weeks(stream: DataFrame, value: str, keys: list[str], delay: str = DELAY) -> DataFrame:
    """keys, week (its Sunday), n (rows), n_days, mean (of daily means), max, min, for each week once it is over."""
    v = F.col(value)
    days = stream.withWatermark("time", delay).groupBy(F.window("time", "1 day").alias("d"), *keys).agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"))
    weeks = days.groupBy(F.window(F.window_time("d"), "7 days", startTime=MONDAY).alias("w"), *keys)
    out = weeks.agg(F.sum("n").alias("n"), F.count("*").alias("n_days"), F.avg("mean").alias("mean"), F.max("max").alias("max"), F.min("min").alias("min"))
    return out.withColumn("week", F.date_sub(F.col("w.end").cast("date"), 1)).drop("w")


def publish_weeks(weeks: DataFrame, name: str = "weeks", folder: str | None = None) -> DataFrame:
    """Write each week that closes as a partition of its own, and a row of the catalogue for it; returns what was published.

    All of a week closes in one batch, so a batch that runs again replaces its weeks by the same rows."""
    spark = weeks.sparkSession
    out = folder or shared_path(spark, name)

    def publish(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, at: str) -> None:
            df.write.partitionBy("week").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{out}/{at}")

        put(batch.repartition("week"), "data")
        closed = batch.groupBy("week").agg(F.count("*").alias("n_keys"), F.sum("n").alias("n"), F.max("n_days").alias("n_days"))
        put(closed.withColumn("batch", F.lit(batch_id)), "catalog")

    writer = weeks.writeStream.option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).foreachBatch(publish)
    writer.start().awaitTermination()
    return spark.read.schema(weeks.schema).parquet(f"{out}/data")


def week_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """week, n_keys, n, n_days, batch of every published week."""
    return spark.read.schema("n_keys long, n long, n_days long, batch long, week date").parquet(f"{folder}/catalog")


def released(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Raw rows (partitioned by week) of published weeks; partitions of other weeks aren't read."""
    return raw.join(F.broadcast(catalog.select("week")), "week", "left_semi")  # 53 rows a year

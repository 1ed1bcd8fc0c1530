"""Daily results that late rows restate.

Every batch of a stream is kept, by day. A day is published when the watermark passes its
end. Rows of days that are over already go to a side table, and their days, only those, are
worked out again from all that was kept and replaced. What a batch does depends on its
rows and on earlier batches alone, and it overwrites its own partitions, so a batch
that runs twice changes nothing. Rows without a time are kept, but belong to no day that is published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.sources.catalog import shared_path
from galesol.streaming.indicators import DELAY

#: Before any row.
START = "0001-01-01 00:00:00"


def _put(df: DataFrame, path: str, *by: str) -> None:
    df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


class Restated:
    """Tables of one restated stream, in one folder: rows (by day and batch), late (by batch), daily (by day), progress (by batch)."""

    def __init__(self, spark: SparkSession, per_day: Callable[[DataFrame], DataFrame], folder: str | None = None, delay: str = DELAY):
        """per_day: a batch aggregation of rows that carry `day`, keeping `day` among its columns."""
        self.spark, self.per_day, self.delay = spark, per_day, delay
        self.folder = folder or shared_path(spark, "restated")

    def _read(self, name: str, ddl) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(ddl).parquet(f"{self.folder}/{name}")

    def _watermark(self, before: int | None = None):
        """The watermark after the batches (before one of them): a timestamp."""
        done = self._read("progress", "watermark timestamp, batch long")
        if done is None:
            return None
        return (done if before is None else done.where(F.col("batch") < before)).agg(F.max("watermark")).first()[0]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One batch, for foreachBatch."""
        day = F.col("time").cast("date")
        names = batch.columns
        _put(batch.withColumn("day", day).withColumn("batch", F.lit(batch_id)), f"{self.folder}/rows", "day", "batch")
        rows = self._read("rows", batch.withColumn("day", day).withColumn("batch", F.lit(batch_id).cast("long")).schema).where(F.col("batch") <= batch_id)
        own = rows.where(F.col("batch") == batch_id)
        newest = own.agg(F.max("time")).first()[0]
        if newest is None:
            return
        before = F.lit(self._watermark(batch_id) or START).cast("timestamp")
        after = F.greatest(before, F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {self.delay}"))
        over = lambda t: F.date_add("day", 1).cast("timestamp") <= t
        late = own.where(over(before))
        _put(late.select(*names, "day", "batch"), f"{self.folder}/late", "batch")
        due = late.select("day").union(rows.where(over(after) & ~over(before)).select("day")).distinct()  # 366 a year
        _put(self.per_day(rows.join(F.broadcast(due), "day", "left_semi").drop("batch")), f"{self.folder}/daily", "day")
        progress = self.spark.range(1).select(after.alias("watermark"), F.lit(batch_id).cast("long").alias("batch"))
        _put(progress, f"{self.folder}/progress", "batch")

    def run(self, stream: DataFrame) -> None:
        """Take all that is there now; a later run goes on from here."""
        stream.writeStream.option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).foreachBatch(self.take).start().awaitTermination()

    def daily(self) -> DataFrame:
        """Published days."""
        return self.spark.read.parquet(f"{self.folder}/daily")

    def late(self) -> DataFrame:
        """Rows that came after their day was over, with their day and batch."""
        return self.spark.read.parquet(f"{self.folder}/late")

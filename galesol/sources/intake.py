"""Intake of files by a manifest, and days that fall due when all their steps are there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

_SEEN = "file string, modified timestamp, length long"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def files_in(spark: SparkSession, source: str) -> DataFrame:
    """file, modified, length of the Parquet files below a folder; their contents aren't read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(source)
    return listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), "length")


class Intake:
    """Takes new files of a folder in, and releases days once.

    folder holds manifest (files taken), rows (by day and file) and released (days given out). Rows of a file overwrite the same
    partitions if it is taken again after a failure, and the manifest is written last, so nothing is lost or taken twice.
    Files don't change: one that is there with another size or time is an error."""

    def __init__(self, spark: SparkSession, source: str, folder: str, steps: int = 24, unit: str = "hour", time: str = "time", keys: list[str] | None = None):
        """steps: distinct units of time (hours) of a day, of every key if keys are given, that make it complete."""
        self.spark, self.source, self.folder, self.steps, self.unit, self.time, self.keys = spark, source, folder, steps, unit, time, keys or []

    def manifest(self) -> DataFrame:
        path = f"{self.folder}/manifest"
        return self.spark.read.schema(_SEEN).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], _SEEN)

    def released(self) -> DataFrame:
        path = f"{self.folder}/released"
        return self.spark.read.schema("day date").parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], "day date")

    def rows(self) -> DataFrame:
        """All rows taken, with day and the hash of their file."""
        return self.spark.read.parquet(f"{self.folder}/rows")

    def take(self) -> int:
        """Take what is new; the number of files taken."""
        new = files_in(self.spark, self.source).join(self.manifest(), ["file", "modified", "length"], "left_anti").cache()
        try:
            changed = new.join(self.manifest().select("file"), "file").first()
            if changed:
                raise ValueError(f"{changed['file']} was taken before and has changed")
            paths = [r["file"] for r in new.select("file").collect()]  # names only, as the scan of them needs
            if not paths:
                return 0
            rows = self.spark.read.parquet(*paths)
            dealt = rows.withColumn("day", F.col(self.time).cast("date")).withColumn("part", F.xxhash64(F.col("_metadata.file_path")))
            dealt.write.partitionBy("day", "part").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{self.folder}/rows")
            new.write.mode("append").parquet(f"{self.folder}/manifest")
            return len(paths)
        finally:
            new.unpersist()

    def due(self) -> DataFrame:
        """Complete days (day) that aren't released; a day that lacks a step, or one of any key, waits."""
        if not _exists(self.spark, f"{self.folder}/rows"):
            return self.spark.createDataFrame([], "day date")
        step = F.date_trunc(self.unit, F.col(self.time))
        waiting = self.rows().join(F.broadcast(self.released()), "day", "left_anti")  # 366 a year
        per = waiting.groupBy("day", *self.keys).agg(F.count_distinct(step).alias("n"))
        whole = per.groupBy("day").agg(F.min("n").alias("n"), F.count("*").alias("k"))
        if self.keys:
            everywhere = self.rows().select(*self.keys).distinct().agg(F.count("*").alias("all"))  # one row
            whole = whole.crossJoin(F.broadcast(everywhere)).where("k = all")
        return whole.where(F.col("n") >= self.steps).select("day")

    def release(self, write: Callable[[DataFrame], None]) -> int:
        """Hand the rows of the days that are due to `write` and note these days as released; their number.

        `write` should replace its days (catalog.write_indicator does): if it fails, they stay due and come again."""
        days = [(r["day"],) for r in self.due().collect()]  # 366 a year
        if days:
            frame = self.spark.createDataFrame(days, "day date")
            write(self.rows().join(F.broadcast(frame), "day", "left_semi").drop("part"))
            frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/released")
        return len(days)

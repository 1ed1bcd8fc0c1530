"""Sinks, run metadata and catalogues of what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; under /tmp only where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or "/tmp/galesol-shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written in the shared folder and read back, so that what several joins use is worked out once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_indicator(df: DataFrame, path: str, date: str = "date", files: int = 4) -> None:
    """Write up to `files` files per date, each by a task of its own; dates that are written again are replaced, others stay."""
    plain = [c for c, t in df.dtypes if not t.startswith("map")]  # a map has no hash
    salt = F.pmod(F.xxhash64(*plain), F.lit(files))
    df.repartition(F.col(date), salt).write.partitionBy(date).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def publish_version(df: DataFrame, path: str) -> int:
    """Add a version of a side table (a mask, a climatology); versions that are there stay, for runs that hold them."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    number = 1 + (spark.read.parquet(path).agg(F.max("version")).first()[0] or 0) if there else 1
    df.withColumn("version", F.lit(number)).write.partitionBy("version").mode("append").parquet(path)
    return number


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a side table, the newest if none is named; other versions aren't read."""
    table = spark.read.parquet(path)
    number = table.agg(F.max("version")).first()[0] if version is None else version
    return table.where(F.col("version") == number)


def file_name(first_time: Column, indicator: str) -> Column:
    return F.concat(F.date_format(first_time, "yyyy_MM_dd_'T'HH_mm_"), F.lit(indicator))


def output_catalog(written: DataFrame, date: str = "date") -> DataFrame:
    """Bounding box and number of rows of each date's output."""
    return written.groupBy(F.col(date).cast("date").alias("date")).agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"), F.count(F.lit(1)).alias("n_rows"))


def file_catalog(spark: SparkSession, path: str) -> DataFrame:
    """As output_catalog, per file, with the date taken from the file's path."""
    rows = spark.read.parquet(path).select("lat", "lon", F.col("_metadata.file_path").alias("file"))
    date = F.to_date(F.regexp_extract("file", r"date=([0-9-]+)", 1))
    return rows.groupBy("file").agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon")).withColumn("date", date)


def latest_input(spark: SparkSession, path: str) -> DataFrame:
    """The file modified last (by path among equals); no row if there is none."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("t")).distinct()
    return files.agg(F.max_by("file", F.struct("t", "file")).alias("file"), F.max("t").alias("modified")).where("file IS NOT NULL")


def run_metadata(inputs: DataFrame, identity: dict[str, Column], message: str, mask: bool) -> DataFrame:
    """One row: the identity keys as a map, the inputs' histories and the message joined by line, and the mask stamp.

    inputs: rows (source, history)."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "history"))), lambda x: x["history"]), "\n")
    keys = F.map_from_arrays(F.array(*map(F.lit, identity)), F.array(*identity.values()))
    return inputs.agg(F.concat_ws("\n", joined, F.lit(message)).alias("history")).select(keys.alias("identity"), "history", F.lit("yes" if mask else "no").alias("mask"))

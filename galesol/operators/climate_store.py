"""A climatology kept up to date: sums by calendar day and year, stored by year, which add up over any choice of years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.functions.calendar import is_leap_day


def add_years(df: DataFrame, path: str, value: str, keys: list[str], time: str = "day") -> None:
    """Store the sums of the years in `df`, which must be whole; years that are there already are replaced, others stay."""
    rows = df.where(~is_leap_day(F.col(time)) & F.col(value).isNotNull())
    sums = rows.groupBy(F.year(time).alias("year"), *keys, F.month(time).alias("month"), F.day(time).alias("dom")).agg(F.sum(F.col(value).cast("double")).alias("total"), F.count(value).alias("n"))
    sums.repartition("year", *keys).write.partitionBy("year").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def climatology(spark: SparkSession, path: str, value: str, keys: list[str], years: tuple[int, int] | None = None) -> DataFrame:
    """Mean per calendar day over the stored years (first and last given, or all), as temporal.daily_climatology gives it from their days.

    Only the sums of these years are read: a row for each key, calendar day and year."""
    table = spark.read.parquet(path)
    if years:
        table = table.where(F.col("year").between(*years))
    return table.groupBy(*keys, "month", "dom").agg((F.sum("total") / F.sum("n")).alias(value))


def stored_years(spark: SparkSession, path: str) -> list[int]:
    return sorted(r["year"] for r in spark.read.parquet(path).select("year").distinct().collect())


def rolling(df: DataFrame, path: str, value: str, keys: list[str], length: int = 30, time: str = "day") -> DataFrame:
    """Add the years in `df` and give the climatology of the last `length` years up to the newest stored; older sums stay, unread."""
    add_years(df, path, value, keys, time)
    newest = stored_years(df.sparkSession, path)[-1]
    return climatology(df.sparkSession, path, value, keys, (newest - length + 1, newest))

"""Scans of gridded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scan_grid(spark: SparkSession, path: str, schema: StructType | None = None, start: str | None = None, end: str | None = None, date: str = "date") -> DataFrame:
    """A grid table between two dates (both included); the filter prunes partitions of `date`."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    return df if end is None else df.where(F.col(date) <= F.lit(end).cast("date"))


def concat_time(parts: list[DataFrame]) -> DataFrame:
    """Files appended along time, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def request_subset(df: DataFrame, params: list[str], start: str, end: str, hours: list[int], area: tuple[float, float, float, float], time: str = "time") -> DataFrame:
    """Columns, dates (both ends), hours and area (north, west, south, east) of a request; all of it reaches the scan."""
    north, west, south, east = area
    t = F.col(time)
    inside = F.col("lat").between(south, north) & F.col("lon").between(west, east)
    return df.where((t >= F.lit(start).cast("timestamp")) & (t < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")) & F.hour(t).isin(hours) & inside).select(time, "lat_idx", "lon_idx", "lat", "lon", *params)


def scan_climatology(df: DataFrame, value: str = "ws", height: float = 100.0, alpha: float = 0.143) -> DataFrame:
    """A 10 m climatology lifted to `height` by the power law."""
    return df.withColumn(value, F.col(value) * F.pow(F.lit(height / 10.0), F.lit(alpha)))


def validate_grid(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row: rows, rows beyond the first of each key, and nulls of each value."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(v).isNull().cast("long")).alias(v) for v in values])
    return per_key.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_repeated"), *[F.sum(v).alias(f"null_{v}") for v in values])


def require_columns(df: DataFrame, types: dict[str, str]) -> None:
    """Raise ValueError, at analysis time, if a column is missing or of another type."""
    have = dict(df.dtypes)
    wrong = [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in types.items() if have.get(c) != t]
    if wrong:
        raise ValueError("; ".join(wrong))


def build_dataset(variables: dict[str, DataFrame], keys: list[str], attributes: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Variables on shared keys joined into one wide table, with attributes as column metadata."""
    frames = [v.select(*keys, F.col(n)) for n, v in variables.items()]
    out = reduce(lambda a, b: a.join(b, keys, "full"), frames)
    for name, meta in (attributes or {}).items():
        out = out.withMetadata(name, meta)
    return out


def check_temperature(df: DataFrame, column: str) -> str:
    """K or C from the column's units metadata, else ValueError."""
    units = df.schema[column].metadata.get("units")
    if units not in ("K", "C"):
        raise ValueError(f"{column} has units {units!r}, not K or C")
    return units

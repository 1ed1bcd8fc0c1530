"""Gridded weather views over the given tables, as DataFrames and as the same SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of a part that one task aggregates.
PART_ROWS = 500_000

OBS_HOURLY_SQL = """SELECT event_id, CAST(ts AS TIMESTAMP) AS time, CAST(user_id AS INT) AS cell_id,
  CAST(floor(user_id / 1.5e1) AS INT) AS lat_idx, CAST(user_id % 15 AS INT) AS lon_idx,
  3.5e1 + 2.5e0 * floor(user_id / 1.5e1) AS lat, CAST((345 + 3 * (user_id % 15)) % 360 AS DOUBLE) AS lon,
  value / 1e1 AS ws, ((event_id * 37) % 61 - 30) / 2e0 AS u, ((event_id * 53) % 59 - 29) / 2e0 AS v,
  2.6815e2 + ((event_id * 13) % 450) / 1e1 AS t2m_k, ((event_id * 71) % 10000) / 1e1 AS g FROM events"""

OBS_DAILY_SQL = """SELECT CAST(l_suppkey AS INT) AS cell_id, CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) / 4e3 AS ws,
  avg(l_quantity) - 1e1 AS tm, avg(l_quantity) - 1e1 + 1e2 * max(l_discount) AS tx, avg(l_quantity) - 1e1 - 1e2 * max(l_tax) AS tn
  FROM lineitem GROUP BY 1, 2"""

DIM_MASK_SQL = """SELECT lat_idx, lon_idx, 3.5e1 + 2.5e0 * lat_idx AS lat, CAST((345 + 3 * lon_idx) % 360 AS DOUBLE) AS lon,
  CASE WHEN (lat_idx * 7 + lon_idx) % 3 = 0 THEN 0e0 ELSE 1e0 END AS mask
  FROM (SELECT DISTINCT CAST(floor(user_id / 1.5e1) AS INT) AS lat_idx, CAST(user_id % 15 AS INT) AS lon_idx FROM events) c"""


def hourly_from(events: DataFrame) -> DataFrame:
    """The hourly view of a batch or a stream of events."""
    user, event = F.col("user_id"), F.col("event_id")
    row = F.floor(user / 15.0)
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("time"), user.cast("int").alias("cell_id"), row.cast("int").alias("lat_idx"), (user % 15).cast("int").alias("lon_idx"),
        (35.0 + 2.5 * row).alias("lat"), ((345 + 3 * (user % 15)) % 360).cast("double").alias("lon"), (F.col("value") / 10.0).alias("ws"),
        (((event * 37) % 61 - 30) / 2.0).alias("u"), (((event * 53) % 59 - 29) / 2.0).alias("v"),
        (268.15 + ((event * 13) % 450) / 10.0).alias("t2m_k"), (((event * 71) % 10000) / 10.0).alias("g"),
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_from(_table(spark, sf_dir, "events"))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key into parts of about PART_ROWS rows, so that what a task aggregates doesn't grow with the table.

    Their number comes from a count, which Parquet answers from its footers. Aggregations by these and further keys need no other exchange."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // PART_ROWS)), *keys)


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.avg("l_quantity") - 10.0
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("cell_id"), F.col("l_shipdate").cast("date").alias("day"), "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    days = dealt(rows, "cell_id").groupBy("cell_id", "day")
    return days.agg((F.avg("l_extendedprice") / 4000.0).alias("ws"), quantity.alias("tm"), (quantity + 100.0 * F.max("l_discount")).alias("tx"), (quantity - 100.0 * F.max("l_tax")).alias("tn"))


def dim_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = obs_hourly(spark, sf_dir).select("lat_idx", "lon_idx", "lat", "lon").distinct()
    return cells.withColumn("mask", F.when((F.col("lat_idx") * 7 + F.col("lon_idx")) % 3 == 0, 0.0).otherwise(1.0))


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, and without negative zero, as the oracle SQL does it; the nudge keeps exact ties from falling either way."""
    return F.round(value + F.lit(1e-9), digits) + F.lit(0.0)

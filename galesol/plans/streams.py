"""Queries that run on Structured Streaming and process everything available; results cover closed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.plans.columns import power_sql
from galesol.plans.registry import query, r
from galesol.sources.fixtures import hourly_from, rounded
from galesol.operators import temporal
from galesol.sources import catalog
from galesol.sources.fixtures import dim_mask, obs_hourly
from galesol.streaming import indicators as I, monthly, restate, weekly

c = F.col
#: A day is closed once the watermark, a day behind the newest event, has passed its end.
CLOSED = "CAST(time AS DATE) + INTERVAL 1 DAY <= (SELECT max(time) - INTERVAL 1 DAY FROM obs_hourly)"


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return hourly_from(I.read_stream(spark, d, "events"))


@query(f"SELECT cell_id, CAST(time AS DATE) AS day, {r('avg(ws)')} AS mean, {r('max(ws)')} AS max, {r('min(ws)')} AS min FROM obs_hourly WHERE {CLOSED} GROUP BY 1, 2")
def stream_daily_stats(spark: SparkSession, d: str) -> DataFrame:
    out = I.run_available(I.stream_daily_stats(_hourly(spark, d), "ws", ["cell_id"]), "daily-stats")
    return out.select("cell_id", "day", *[rounded(c(n)).alias(n) for n in ("mean", "max", "min")])


@query(f"SELECT cell_id, month, CAST(least(floor((cf - 0e0) / 1e0 * 30), 29) AS INTEGER) AS bin, count(*) AS count FROM (SELECT cell_id, CAST(date_trunc('month', time) AS DATE) AS month, power / rated AS cf FROM p WHERE {CLOSED}) GROUP BY 1, 2, 3", p=power_sql("obs_hourly", ["I"]))
def stream_cf_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Daily partial counts as they close, rolled up to months."""
    days = I.stream_histogram(I.stream_capacity_factor(_hourly(spark, d), "I"), "cf", ["cell_id"], 30)
    return I.monthly(I.run_available(days, "cf-histogram"), ["cell_id"]).select("cell_id", "month", "bin", "count")


@query(f"SELECT event_id, cell_id, {r('power / rated')} AS cf FROM p", p=power_sql("obs_hourly", ["I"]))
def stream_indicator(spark: SparkSession, d: str) -> DataFrame:
    rows = I.stream_capacity_factor(_hourly(spark, d), "I").select("event_id", "cell_id", rounded(c("cf")).alias("cf"))
    return I.run_available(rows, "indicator")


@query("SELECT event_id, cell_id, ws, CAST(date_trunc('week', CAST(time AS DATE)) AS DATE) + 6 AS week FROM obs_hourly")
def stream_raw_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = I.stream_raw_by_week(_hourly(spark, d)).select("event_id", "cell_id", "ws", "week")
    return I.run_available(rows, "raw", ["week"])


@query(f"SELECT cell_id, CAST(time AS DATE) AS day, sum(CASE WHEN ws > 25 THEN 1 ELSE 0 END)::BIGINT AS n_high, sum(CASE WHEN ws < 3 THEN 1 ELSE 0 END)::BIGINT AS n_low FROM obs_hourly WHERE {CLOSED} GROUP BY 1, 2")
def stream_event_counts(spark: SparkSession, d: str) -> DataFrame:
    return I.run_available(I.stream_event_counts(_hourly(spark, d), "ws", ["cell_id"]), "event-counts").select("cell_id", "day", "n_high", "n_low")


#: A year out of the month of observations: times from its start, stretched twelvefold.
START_US = 1_704_067_200_000_000
_YEAR = f"SELECT * REPLACE (make_timestamp({START_US} + 12 * (epoch_us(time) - {START_US})) AS time) FROM obs_hourly"


def _year(hours: DataFrame) -> DataFrame:
    return hours.withColumn("time", F.timestamp_micros(F.lit(START_US) + 12 * (F.unix_micros("time") - F.lit(START_US))))


@query(
    """SELECT k.cell_id, k.month, b.bin, coalesce(n.n, 0)::BIGINT AS count FROM (SELECT DISTINCT cell_id, month FROM rows_) k CROSS JOIN (SELECT range::INTEGER AS bin FROM range(30)) b
  LEFT JOIN (SELECT cell_id, month, CAST(least(floor((cf - 0e0) / 1e0 * 30), 29) AS INTEGER) AS bin, count(*) AS n FROM rows_ GROUP BY ALL) n ON n.cell_id = k.cell_id AND n.month = k.month AND n.bin = b.bin""",
    year_=_YEAR,
    rows_=f"SELECT cell_id, CAST(date_trunc('month', time) AS DATE) AS month, power / rated AS cf FROM ({power_sql('year_', ['I'])}) WHERE date_trunc('month', time) + INTERVAL 1 MONTH <= (SELECT max(time) - INTERVAL 1 DAY FROM year_)",
)
def stream_month_histogram(spark: SparkSession, d: str) -> DataFrame:
    """A month's capacity-factor counts of each cell, once the month is over."""
    months = monthly.stream_month_histogram(I.stream_capacity_factor(_year(_hourly(spark, d)), "I"), "cf", ["cell_id"], 30)
    return I.run_available(months, "months", timers=True).select("cell_id", "month", "bin", "count")


@query(f"SELECT cell_id, CAST(time AS DATE) AS day, count(*) AS n, {r('avg(ws)')} AS mean, {r('max(ws)')} AS max, {r('min(ws)')} AS min FROM obs_hourly WHERE {CLOSED} GROUP BY 1, 2")
def stream_restated_days(spark: SparkSession, d: str) -> DataFrame:
    """Daily statistics of rows that come in four batches, each with rows of every day, so that most days are restated."""
    path = catalog.shared_path(spark, "shuffled")
    events = spark.read.parquet(f"{d}/events.parquet")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    stream = hourly_from(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path))
    v = F.col("ws")
    per_day = lambda rows: rows.groupBy("cell_id", "day").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"))
    days = restate.Restated(spark, per_day)
    days.run(stream.select("event_id", "cell_id", "time", "ws"))
    return days.daily().select("cell_id", "day", "n", *[rounded(c(n)).alias(n) for n in ("mean", "max", "min")])


@query(
    f"""SELECT cell_id, CAST(date_trunc('week', day) AS DATE) + 6 AS week, sum(n)::BIGINT AS n, count(*) AS n_days, {r('avg(mean)')} AS mean, {r('max(mx)')} AS max, {r('min(mn)')} AS min FROM days
  WHERE date_trunc('week', day) + INTERVAL 7 DAY <= (SELECT max(time) - INTERVAL 1 DAY FROM obs_hourly) GROUP BY 1, 2""",
    days="SELECT cell_id, CAST(time AS DATE) AS day, count(*) AS n, avg(ws) AS mean, max(ws) AS mx, min(ws) AS mn FROM obs_hourly GROUP BY 1, 2",
)
def stream_weekly_release(spark: SparkSession, d: str) -> DataFrame:
    """Weeks published as they close, from daily windows."""
    out = weekly.publish_weeks(weekly.stream_weeks(_hourly(spark, d), "ws", ["cell_id"]))
    return out.select("cell_id", "week", "n", "n_days", *[rounded(c(n)).alias(n) for n in ("mean", "max", "min")])


@query(f"SELECT cell_id, 2 AS version, CAST(time AS DATE) AS day, sum(CASE WHEN ws > 25 THEN 1 ELSE 0 END)::BIGINT AS n_high, sum(CASE WHEN ws < 3 THEN 1 ELSE 0 END)::BIGINT AS n_low FROM obs_hourly JOIN dim_mask USING (lat_idx, lon_idx) WHERE mask > 5e-1 AND {CLOSED} GROUP BY 1, 3")
def stream_masked_event_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of unmasked cells, by the newest of two versions of the mask."""
    path = catalog.shared_path(spark, "masks")
    mask = dim_mask(spark, d)
    catalog.publish_version(mask.withColumn("mask", F.lit(1.0)), path)
    catalog.publish_version(mask, path)
    counts = I.stream_masked_event_counts(_hourly(spark, d), catalog.read_version(spark, path), "ws", ["cell_id"], ["lat_idx", "lon_idx"])
    return I.run_available(counts, "masked-counts").select("cell_id", "version", "day", "n_high", "n_low")


@query(
    f"SELECT event_id, cell_id, {r('ws - base')} AS departure FROM obs_hourly o JOIN base_ b USING (cell_id) WHERE month(o.time) = b.month AND day(o.time) = b.dom",
    base_="SELECT cell_id, month(time) AS month, day(time) AS dom, avg(ws) AS base FROM obs_hourly GROUP BY 1, 2, 3",
)
def stream_departure(spark: SparkSession, d: str) -> DataFrame:
    """Each arriving value less the stored mean of its calendar day."""
    path = catalog.shared_path(spark, "climatology")
    catalog.publish_version(temporal.daily_climatology(obs_hourly(spark, d), "ws", ["cell_id"], "time").withColumnRenamed("ws", "base"), path)
    out = I.stream_departure(_hourly(spark, d), catalog.read_version(spark, path).drop("version"), "ws", ["cell_id"])
    return I.run_available(out.select("event_id", "cell_id", rounded(c("departure")).alias("departure")), "departure")

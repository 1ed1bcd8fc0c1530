"""Resampling, counts, percentiles, climatologies, windows and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from galesol.functions.calendar import calendar_bin, is_leap_day


def rescale(df: DataFrame, value: str, scale: str, keys: list[str], time: str = "time", fill_gaps: bool = False) -> DataFrame:
    """Mean per calendar bin and cell: keys, bin, value. fill_gaps adds null rows for empty bins between a cell's first and last."""
    out = df.groupBy(*keys, calendar_bin(F.col(time), scale).alias("bin")).agg(F.avg(value).alias(value))
    if not fill_gaps:
        return out
    days = df.groupBy(*keys).agg(F.min(F.col(time).cast("date")).alias("lo"), F.max(F.col(time).cast("date")).alias("hi"))
    spine = days.withColumn("bin", F.explode(F.array_distinct(F.transform(F.sequence("lo", "hi"), lambda d: calendar_bin(d, scale))))).drop("lo", "hi")
    return spine.join(out, [*keys, "bin"], "left")


def daily_stats(df: DataFrame, value: str, keys: list[str], time: str = "time") -> DataFrame:
    v = F.col(value)
    return df.groupBy(*keys, F.col(time).cast("date").alias("day")).agg(F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"))


def count_where(df: DataFrame, hit: Column, value: str, keys: list[str], extra: list[Column] | None = None, null_as_zero: bool = True) -> DataFrame:
    """n_hits, and n_valid rows, per key; null values are no hits. Without null_as_zero, a key that has only nulls has null hits.

    extra: further aggregates."""
    hits = F.sum(F.when(hit, 1).otherwise(0)).cast("long")
    return df.groupBy(*keys).agg((hits if null_as_zero else F.when(F.count(value) > 0, hits)).alias("n_hits"), F.count(value).alias("n_valid"), *(extra or []))


def percentile(df: DataFrame, value: str, p: float, keys: list[str], approximate: bool = False) -> DataFrame:
    """Linear-interpolated percentile (p in 0..100). The exact form holds a group's distinct values; large groups take the approximate one."""
    f = F.percentile_approx(value, p / 100.0, 10_000) if approximate else F.percentile(value, p / 100.0)
    return df.groupBy(*keys).agg(f.alias("percentile"))


def time_mean(df: DataFrame, value: str, keys: list[str], skipna: bool = False) -> DataFrame:
    """Mean over time; unless skipna, one null makes the cell null."""
    mean = F.avg(value)
    return df.groupBy(*keys).agg((mean if skipna else F.when(F.count(value) == F.count(F.lit(1)), mean)).alias("mean"))


def daily_climatology(df: DataFrame, value: str, keys: list[str], time: str = "day") -> DataFrame:
    """Mean per calendar day and cell over all years, 29 February left out."""
    rows = df.where(~is_leap_day(F.col(time)))
    return rows.groupBy(*keys, F.month(time).alias("month"), F.day(time).alias("dom")).agg(F.avg(value).alias(value))


def climatology_smooth(clim: DataFrame, value: str, keys: list[str], half: int = 1) -> DataFrame:
    """Running mean over neighbouring calendar days (present ones), 31 December being next to 1 January.

    A day's ordinal is that of a year without leap day; each cell's 365 rows are padded at both ends."""
    ordinal = F.dayofyear(F.make_date(F.lit(2001), F.col("month"), F.col("dom")))
    rows = clim.withColumn("n", ordinal).withColumn("own", F.lit(True))
    before = rows.where(F.col("n") > 365 - half).withColumn("n", F.col("n") - 365).withColumn("own", F.lit(False))
    after = rows.where(F.col("n") <= half).withColumn("n", F.col("n") + 365).withColumn("own", F.lit(False))
    w = Window.partitionBy(*keys).orderBy("n").rangeBetween(-half, half)
    return rows.union(before).union(after).withColumn(value, F.avg(value).over(w)).where("own").drop("n", "own")


def climatology_join(df: DataFrame, clim: DataFrame, keys: list[str], time: str = "day") -> DataFrame:
    """Each row with the climatology of its calendar day; 29 February has none and goes."""
    rows = df.withColumn("month", F.month(time)).withColumn("dom", F.day(time))
    return rows.join(clim, [*keys, "month", "dom"])


def anomalies(df: DataFrame, clim: DataFrame, value: str, base: str, scale: str, keys: list[str], time: str = "day") -> DataFrame:
    """Mean of the value less mean of the climatology per bin and cell."""
    joined = climatology_join(df, clim, keys, time)
    return joined.groupBy(*keys, calendar_bin(F.col(time), scale).alias("bin")).agg((F.avg(value) - F.avg(base)).alias("anomaly"))


def moving_average(df: DataFrame, value: str, width: int, keys: list[str], order: list[str]) -> DataFrame:
    """Trailing mean over `width` steps; the first width - 1 rows of a cell go."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("moving", F.avg(value).over(w.rowsBetween(1 - width, 0))).withColumn("__n", F.row_number().over(w))
    return rows.where(F.col("__n") >= width).drop("__n")


def cumulative(df: DataFrame, value: str, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("cumulative", F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def trend(monthly: DataFrame, value: str, keys: list[str], date: str = "bin") -> DataFrame:
    """Least-squares slope and intercept against the day number since 1970."""
    x = F.datediff(F.col(date), F.lit("1970-01-01").cast("date")).cast("double")
    return monthly.groupBy(*keys).agg(F.regr_slope(F.col(value), x).alias("slope"), F.regr_intercept(F.col(value), x).alias("intercept"))


def calendar_pivot(df: DataFrame, value: str, keys: list[str], time: str = "day") -> DataFrame:
    """A row per key, year and month with a column per day of month."""
    rows = df.select(*keys, F.year(time).alias("year"), F.month(time).alias("month"), F.day(time).alias("dom"), value)
    out = rows.groupBy(*keys, "year", "month").pivot("dom", list(range(1, 32))).agg(F.first(value))
    return out.toDF(*[c if not c.isdigit() else f"d{int(c):02d}" for c in out.columns])

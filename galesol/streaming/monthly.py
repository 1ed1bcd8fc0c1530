"""Monthly histograms with state: a month's counts are kept per key and come out once, when the watermark passes the month's end.

Months have no fixed length, which windows need. So rows get a time of their own, on which every
month begins a multiple of 32 days after the first one and runs as it does on the calendar: windows of
32 days are months there, and a watermark that stays `delay` behind passes the end of a month
when the newest row is `delay` into the next. Rows of a month that is over are late and dropped;
streaming.restate takes those back in. A restart goes on with the counts of an open month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from galesol.operators.histogram import bin_of
from galesol.streaming.indicators import DELAY

#: Days from the beginning of a month to that of the next on the rows' own time.
SPAN = 32
_DAY_US = 86_400_000_000


def _even(time: Column) -> Column:
    """The time on an axis on which each month takes SPAN days."""
    month = F.trunc(time.cast("date"), "month")
    number = (F.year(month) - 1970) * 12 + F.month(month) - 1
    return F.timestamp_micros(number.cast("long") * SPAN * _DAY_US + F.unix_micros(time) - F.unix_micros(month.cast("timestamp")))


def stream_month_histogram(stream: DataFrame, value: str, keys: list[str], bins: int, delay: str = DELAY) -> DataFrame:
    """keys, month, bin (all bins), count of a value in [0, 1], for each month once it is over.

    The delay is to be shorter than a month (28 days)."""
    rows = stream.where(F.col(value).between(0.0, 1.0)).select(*keys, _even(F.col("time")).alias("even"), bin_of(F.col(value), F.lit(0.0), F.lit(1.0), bins).alias("bin"))
    counts = [F.count_if(F.col("bin") == i).alias(f"n{i}") for i in range(bins)]
    months = rows.withWatermark("even", delay).groupBy(*keys, F.window("even", f"{SPAN} days").alias("w")).agg(*counts)
    month = F.add_months(F.lit("1970-01-01").cast("date"), (F.unix_micros("w.start") / (SPAN * _DAY_US)).cast("int"))
    return months.select(*keys, month.alias("month"), F.posexplode(F.array(*[F.col(f"n{i}") for i in range(bins)])).alias("bin", "count"))

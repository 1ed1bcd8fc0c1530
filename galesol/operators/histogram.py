"""Histograms in long form: keys, bin (from 0), lo, hi, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from galesol.operators.grid import small


def bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin of x among equal bins; the largest value falls in the last."""
    return F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")


def _filled(counts: DataFrame, edges: DataFrame, keys: list[str], bins: int) -> DataFrame:
    spine = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    out = spine.join(counts, [*keys, "bin"], "left")
    return out.select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("lo"), (F.col("lo") + (F.col("bin") + 1) * width).alias("hi"), F.coalesce("count", F.lit(0)).alias("count"))


def histogram(df: DataFrame, value: str, keys: list[str], bins: int) -> DataFrame:
    """Counts between each key's own least and largest value; a constant key has half a unit either side. Nulls are left out."""
    rows = df.where(F.col(value).isNotNull())
    same = F.min(value) == F.max(value)
    edges = rows.groupBy(*keys).agg((F.min(value) - F.when(same, 0.5).otherwise(0.0)).alias("lo"), (F.max(value) + F.when(same, 0.5).otherwise(0.0)).alias("hi"))
    edges = small(edges) if keys else edges  # one row a key
    binned = rows.join(edges, keys) if keys else rows.crossJoin(F.broadcast(edges))  # one row without keys
    counts = binned.withColumn("bin", bin_of(F.col(value), F.col("lo"), F.col("hi"), bins)).groupBy(*keys, "bin").count()
    return _filled(counts, edges, keys, bins)


def fixed_histogram(df: DataFrame, value: str, keys: list[str], bins: int, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Counts between fixed edges, which add up over any partition of the rows; values outside are left out."""
    rows = df.where(F.col(value).between(lo, hi))
    counts = rows.groupBy(*keys, bin_of(F.col(value), F.lit(lo), F.lit(hi), bins).alias("bin")).count()
    edges = df.select(*keys).distinct().withColumn("lo", F.lit(lo)).withColumn("hi", F.lit(hi))
    return _filled(counts, edges, keys, bins)


def packed_counts(df: DataFrame, value: str, keys: list[str], bins: int, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """As fixed_histogram, in one row a key: an array of `bins` counts. Keys whose values all lie outside have zeros."""
    bin_ = F.when(F.col(value).between(lo, hi), bin_of(F.col(value), F.lit(lo), F.lit(hi), bins))
    counts = df.groupBy(*keys, bin_.alias("bin")).count()
    found = F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "count"))))
    return counts.groupBy(*keys).agg(found.alias("found")).select(*keys, F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0).cast("long"))).alias("counts"))


def density(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Adds density: count over (n x width)."""
    totals = hist.groupBy(*keys).agg(F.sum("count").alias("__n"))
    out = hist.join(totals, keys)
    return out.withColumn("density", F.try_divide(F.col("count").cast("double"), F.col("__n") * (F.col("hi") - F.col("lo")))).drop("__n")


def packed(hist: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: arrays of counts, and of the edges."""
    rows = F.array_sort(F.collect_list(F.struct("bin", "lo", "hi", "count")))
    out = hist.groupBy(*keys).agg(rows.alias("h"))
    return out.select(*keys, F.col("h.count").alias("counts"), F.concat(F.col("h.lo"), F.array(F.element_at("h.hi", -1))).alias("edges"))

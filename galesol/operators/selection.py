"""Exact percentiles of groups of any size, by rounds of histograms that narrow the range in which they lie."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from galesol.operators.grid import small
from galesol.sources.catalog import kept

#: Bins of a round; rows left in a range that are then put in order.
BINS, FEW = 1024, 1000


def exact_percentile(df: DataFrame, value: str, p: float, keys: list[str]) -> DataFrame:
    """keys, percentile: linear-interpolated (p in 0..100), as temporal.percentile gives it. Nulls and NaN are left out; null keys are a group.

    Every group looks for the values at two ranks. A round counts the rows of the range in which a rank lies, by BINS equal bins
    with partial sums, and takes the bin that holds it, with its own least and largest value; so ranges shrink until they hold one value, or
    FEW rows, of which the one at the rank is taken. A task never holds a group: what is kept of one is BINS counts."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(value).cast("double").alias("__v"))
    facts = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    at = (F.col("__n") - 1) * F.lit(p / 100.0)
    sides = F.explode(F.array(F.struct(F.lit(0).alias("t"), F.floor(at).alias("rank")), F.struct(F.lit(1).alias("t"), F.ceil(at).alias("rank"))))
    found = kept(facts.where("__n > 0").select(*keys, (at - F.floor(at)).alias("__share"), sides.alias("s"), "__n", "__a", "__b").select(*keys, "__share", F.col("s.t").alias("__t"), F.col("s.rank").alias("__rank"), "__n", "__a", "__b"), "ranks")
    target = [*keys, "__t"]

    def inside(state: DataFrame) -> DataFrame:
        side = small(state.withColumnsRenamed({k: f"__of_{k}" for k in keys}))
        same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
        both = rows.join(side, reduce(Column.__and__, same)) if keys else rows.crossJoin(side)  # two ranks without keys
        return both.where("__v BETWEEN __a AND __b").drop(*[f"__of_{k}" for k in keys])

    while True:
        wide = found.where(f"__a < __b AND __n > {FEW}")
        if wide.isEmpty():
            break
        # Halves, so that a range as wide as all doubles has no infinite width.
        part = (F.col("__v") / 2 - F.col("__a") / 2) / (F.col("__b") / 2 - F.col("__a") / 2) * BINS
        inner = F.least(F.greatest(F.floor(F.nanvl(part, F.lit(BINS / 2))), F.lit(0)), F.lit(BINS - 1))
        # The ends have bins of their own side, so that a range always parts, infinite ones too.
        bins = inside(wide).withColumn("__bin", F.when(F.col("__v") == F.col("__a"), 0).when(F.col("__v") == F.col("__b"), BINS - 1).otherwise(inner).cast("int"))
        bins = bins.groupBy(*target, "__share", "__rank", "__bin").agg(F.count("*").alias("__n"), F.min("__v").alias("__a"), F.max("__v").alias("__b"))
        before = F.sum("__n").over(Window.partitionBy(*target).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
        held = bins.withColumn("__before", before).where("__rank >= __before AND __rank < __before + __n")
        narrow = held.select(*keys, "__share", "__t", (F.col("__rank") - F.col("__before")).alias("__rank"), "__n", "__a", "__b")
        found = kept(found.where(f"NOT (__a < __b AND __n > {FEW})").unionByName(narrow), "ranks")
    one = found.where("__a = __b").select(*target, "__share", F.col("__a").alias("__x"))
    row = F.row_number().over(Window.partitionBy(*target).orderBy("__v"))
    few = inside(found.where("__a < __b")).withColumn("__i", row).where("__i = __rank + 1").select(*target, "__share", F.col("__v").alias("__x"))
    low, high = F.min(F.when(F.col("__t") == 0, F.col("__x"))), F.max(F.when(F.col("__t") == 1, F.col("__x")))
    return one.unionByName(few).groupBy(*keys).agg(F.when(low == high, low).otherwise(low + (high - low) * F.max("__share")).alias("percentile"))

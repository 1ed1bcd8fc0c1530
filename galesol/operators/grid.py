"""Grid work: regions, points, masks, regridding. Cells are keyed by integer indices; coordinates are payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from galesol.sources.catalog import kept

CELL = ["lat_idx", "lon_idx"]
#: Tables of axes, cells, edges and curves up to this many bytes are broadcast; larger ones are shuffled.
SMALL_BYTES = 64 << 20
#: Ranges that an axis is cut into.
BANDS = 64


def small(df: DataFrame) -> DataFrame:
    """Store a table of axes, cells or edges, and hint its broadcast only where its bytes, summed while it is written, are within bounds."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    seen = Observation()
    out = kept(df.observe(seen, F.sum(reduce(Column.__add__, wide, F.lit(16 * (1 + len(df.columns)))).cast("long")).alias("bytes")), "small")
    return F.broadcast(out) if (seen.get["bytes"] or 0) <= SMALL_BYTES else out


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in all floating columns: Spark orders NaN above every number."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def level_squeeze(df: DataFrame, level: str = "level_idx") -> DataFrame:
    return df.where(F.col(level) == 0).drop(level)


def edge_trim(df: DataFrame) -> DataFrame:
    """Drop the first row of latitudes and the last column of longitudes."""
    last = df.agg(F.max("lon_idx").alias("__last"))
    return df.crossJoin(F.broadcast(last)).where((F.col("lat_idx") >= 1) & (F.col("lon_idx") < F.col("__last"))).drop("__last")  # one row


def relabel_lat(df: DataFrame, start: float = 27.0, stop: float = 72.0) -> DataFrame:
    """Latitudes become evenly spaced from start to stop by index."""
    last = df.agg(F.max("lat_idx").alias("__n"))
    step = F.try_divide(F.lit(stop - start) * F.col("lat_idx"), F.col("__n"))
    return df.crossJoin(F.broadcast(last)).withColumn("lat", F.lit(start) + F.coalesce(step, F.lit(0.0))).drop("__n")  # one row


def select_region(df: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """Rows inside a box, both ends included, whatever the order of the axes."""
    return df.where(F.col("lat").between(min(lat), max(lat)) & F.col("lon").between(min(lon), max(lon)))


def wrapped(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def axes(df: DataFrame) -> DataFrame:
    """The distinct coordinates (axis, idx, x) of a grid's rows, both axes in one pass."""
    one = lambda n: F.struct(F.lit(n).alias("axis"), F.col(f"{n}_idx").alias("idx"), F.col(n).alias("x"))
    return df.select(F.explode(F.array(one("lat"), one("lon"))).alias("a")).select("a.*").distinct()


def nearest_axes(own: DataFrame, other: DataFrame, prefer: str, reach: bool = False) -> DataFrame:
    """Axis maps (axis, idx, other_idx) of nearest coordinates; `prefer` says which coordinate wins a tie.

    own, other: distinct (axis, idx, x). Both are sorted together within ranges of an axis; a row looks at the last smaller
    and the next larger coordinate of the other grid, which may lie in another range. reach: own coordinates outside
    the other axis find nothing, as do null ones."""
    b = other.where("x IS NOT NULL")
    ends = b.groupBy("axis").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    none = lambda df: F.lit(None).cast(df.schema["idx"].dataType)
    both = own.where("x IS NOT NULL").select("axis", "idx", none(b).alias("other_idx"), "x")
    both = both.union(b.select("axis", none(own).alias("idx"), F.col("idx").alias("other_idx"), "x")).join(F.broadcast(ends), "axis")  # a row for each axis
    if reach:
        both = both.where("x BETWEEN lo AND hi")
    part = F.coalesce(F.try_divide((F.col("x") - F.col("lo")) * BANDS, F.col("hi") - F.col("lo")), F.lit(0.0))
    both = both.withColumn("band", F.least(F.greatest(F.floor(part), F.lit(0)), F.lit(BANDS - 1)).cast("int"))
    known = F.when(F.col("other_idx").isNotNull(), F.struct(F.col("x").alias("y"), "other_idx"))
    met = lambda order: F.last(known, ignorenulls=True).over(Window.partitionBy("axis", "band").orderBy(order, F.col("other_idx").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    rows = both.withColumn("below", met(F.col("x").asc())).withColumn("above", met(F.col("x").desc()))
    # What the ranges before and behind hold: BANDS rows for each axis.
    held = both.groupBy("axis", "band").agg(F.max(known).alias("top"), F.min(known).alias("bottom"))
    edge = lambda side, order: F.last(side, ignorenulls=True).over(Window.partitionBy("axis").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("axis", "band", edge("top", F.col("band").asc()).alias("before"), edge("bottom", F.col("band").desc()).alias("behind"))
    rows = rows.where("idx IS NOT NULL").join(F.broadcast(held), ["axis", "band"])
    below, above = F.coalesce("below", "before"), F.coalesce("above", "behind")
    down, up = F.col("x") - below["y"], above["y"] - F.col("x")
    near = F.when(above.isNull() | (down <= up if prefer == "smaller" else down < up), below).otherwise(above)
    return rows.select("axis", "idx", near["other_idx"].alias("other_idx")).where("other_idx IS NOT NULL")


def axis_map(near: DataFrame, name: str) -> DataFrame:
    """One axis of nearest_axes: (lat_idx, other_lat_idx) or the like."""
    return near.where(F.col("axis") == name).select(F.col("idx").alias(f"{name}_idx"), F.col("other_idx").alias(f"other_{name}_idx"))


def axis(df: DataFrame, name: str) -> DataFrame:
    return df.select(f"{name}_idx", name).distinct()


def onshore_mask(df: DataFrame, mask: DataFrame, values: list[str]) -> DataFrame:
    """Null the values of cells whose nearest mask cell is not above 0.5, or that lie outside the mask.

    Nearest per axis, ties to the smaller coordinate. The grid's axes meet the mask's, and land cells of the mask become
    those of the grid by the axis maps, so hours never meet the mask by distance."""
    near = small(nearest_axes(axes(df), axes(mask), "smaller", reach=True))
    land = mask.where("mask > 0.5").select(F.col("lat_idx").alias("other_lat_idx"), F.col("lon_idx").alias("other_lon_idx"))
    land = land.join(axis_map(near, "lat"), "other_lat_idx").join(axis_map(near, "lon"), "other_lon_idx").select(*CELL, F.lit(True).alias("__land"))
    out = df.join(small(land), CELL, "left")
    return out.select(*[F.when(F.col("__land"), F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def regrid_nearest(df: DataFrame, lat: DataFrame, lon: DataFrame, values: list[str]) -> DataFrame:
    """Values on a target grid, each cell taking its nearest source cell (per axis, ties to the smaller coordinate).

    lat, lon: target axes (idx, coordinate)."""
    target = lat.toDF("idx", "x").select(F.lit("lat").alias("axis"), "idx", "x").union(lon.toDF("idx", "x").select(F.lit("lon").alias("axis"), "idx", "x"))
    near = nearest_axes(target, axes(df), "smaller").join(target, ["axis", "idx"])
    near = small(near)
    side = lambda n: near.where(F.col("axis") == n).select(F.col("other_idx").alias(f"other_{n}_idx"), F.col("idx").alias(f"{n}_idx"), F.col("x").alias(n))
    source = df.select(F.col("lat_idx").alias("other_lat_idx"), F.col("lon_idx").alias("other_lon_idx"), *[c for c in df.columns if c in values or c not in ("lat", "lon", *CELL)])
    return source.join(side("lat"), "other_lat_idx").join(side("lon"), "other_lon_idx").drop("other_lat_idx", "other_lon_idx")


def dense_cell_id(mask: DataFrame) -> DataFrame:
    """Unmasked cells with ids 0..n-1 in row-major order.

    Tasks number their ranges of cells by themselves; what comes before a range is summed over one row for each task."""
    ordered = mask.where("mask > 0.5").select(*CELL).repartitionByRange(*CELL).sortWithinPartitions(*CELL)
    # An id is the task's number and, in its last 33 bits, the row's; ranges are sampled anew each time, so they are stored.
    numbered = kept(ordered.withColumn("n", F.monotonically_increasing_id()), "cells")
    task, row = F.shiftright("n", 33), F.col("n").bitwiseAND((1 << 33) - 1)
    tasks = numbered.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    before = tasks.select("task", (F.sum("rows").over(Window.orderBy("task")) - F.col("rows")).alias("before"))
    return numbered.withColumn("task", task).join(F.broadcast(before), "task").select(*CELL, (F.col("before") + row).cast("long").alias("cell"))  # a row for each task


def mask_compact(df: DataFrame, mask: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Rows of unmasked cells, with their dense id. cells: dense_cell_id(mask), if at hand."""
    return df.join(small(dense_cell_id(mask) if cells is None else cells), CELL)


def mask_scatter(result: DataFrame, mask: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Compact results (by `cell`) back on the full grid; masked cells are null. cells: dense_cell_id(mask), if at hand."""
    full = mask.select(*CELL).join(dense_cell_id(mask) if cells is None else cells, CELL, "left")
    return full.join(result, "cell", "left").drop("cell")


def select_point(df: DataFrame, lat: float, lon: float) -> DataFrame:
    """Rows of the cell whose latitude and longitude are each nearest to the point; ties to the larger coordinate."""

    def near(name: str, x: float) -> DataFrame:
        c = F.col(name)
        return axis(df, name).agg(F.min_by(f"{name}_idx", F.struct(F.abs(c - F.lit(x)), -c)).alias(f"{name}_idx"))

    return df.join(F.broadcast(near("lat", lat)), "lat_idx").join(F.broadcast(near("lon", lon)), "lon_idx")  # one row each

"""Power curves from files: knots, monotone cubic pieces and power by piece, for any number of curves and any spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from galesol.operators.grid import small

#: Width (m/s) of the speed bins by which hours meet pieces.
BIN = 0.5


def read_power_curves(spark: SparkSession, path: str) -> DataFrame:
    """Knots (curve, wind_speed, power) of CSV files: a title line, whose first field names the curve, a line of column names, then speed and power.

    A file is one row first, since a curve has some dozens of knots. Empty lines don't count; a number that can't be read is an error."""
    lines = F.filter(F.transform(F.split("value", "\r?\n"), lambda s: F.trim(s)), lambda s: s != "")
    files = spark.read.text(path, wholetext=True).select(lines.alias("lines"))
    knots = files.select(F.trim(F.element_at(F.split(F.get("lines", F.lit(0)), ","), 1)).alias("curve"), F.explode(F.slice("lines", 3, 1 << 30)).alias("line"))
    field = lambda i: F.trim(F.element_at(F.split("line", ","), i)).cast("double")
    return knots.select("curve", field(1).alias("wind_speed"), field(2).alias("power"))


def cubic_pieces(knots: DataFrame) -> DataFrame:
    """Monotone piecewise cubics (curve, k, x, x1, y, m, c, b, last): y + t (m + t (c + t b)) for t = speed - x.

    Knots may come in any order and spacing; one given twice counts once, with its mean power. Inner slopes are weighted
    harmonic means of the rises on either side, or 0 at a turn; those at the ends are of three points, held to the
    shape of the data; two knots make a line. A curve of one knot has no piece."""
    w = Window.partitionBy("curve").orderBy("x")  # a curve's knots
    step = knots.groupBy("curve", F.col("wind_speed").alias("x")).agg(F.avg("power").alias("y"))
    step = step.withColumn("x1", F.lead("x").over(w)).withColumn("y1", F.lead("y").over(w)).withColumn("k", F.row_number().over(w) - 1)
    step = step.withColumn("h", F.col("x1") - F.col("x")).withColumn("d", F.try_divide(F.col("y1") - F.col("y"), F.col("h")))
    for name in ("h", "d"):
        near = {f"{name}_1": F.lag(name, 1), f"{name}_2": F.lag(name, 2), f"{name}1": F.lead(name, 1)}
        step = step.withColumns({n: f.over(w) for n, f in near.items()})
    c = F.col

    def end(near_h: Column, near_d: Column, far_h: Column, far_d: Column) -> Column:
        m = F.try_divide((2.0 * near_h + far_h) * near_d - near_h * far_d, near_h + far_h)
        held = F.when(m * near_d <= 0, F.lit(0.0)).when((near_d * far_d <= 0) & (F.abs(m) > F.abs(3.0 * near_d)), 3.0 * near_d).otherwise(m)
        return F.when(far_d.isNull(), near_d).otherwise(held)

    w1, w2 = 2.0 * c("h") + c("h_1"), c("h") + 2.0 * c("h_1")
    inner = F.when(c("d_1") * c("d") <= 0, F.lit(0.0)).otherwise(F.try_divide(w1 + w2, F.try_divide(w1, c("d_1")) + F.try_divide(w2, c("d"))))
    slope = F.when(c("d_1").isNull(), end(c("h"), c("d"), c("h1"), c("d1"))).when(c("d").isNull(), end(c("h_1"), c("d_1"), c("h_2"), c("d_2"))).otherwise(inner)
    step = step.withColumn("m", slope)
    step = step.withColumn("m1", F.lead("m").over(w)).withColumn("last", F.lead("x", 2).over(w).isNull()).where("x1 IS NOT NULL")
    cubic = (3.0 * c("d") - 2.0 * c("m") - c("m1")) / c("h")
    return step.select("curve", "k", "x", "x1", "y", "m", cubic.alias("c"), ((c("m") - 2.0 * c("d") + c("m1")) / (c("h") * c("h"))).alias("b"), "last")


def power_by_curve(df: DataFrame, pieces: DataFrame, specs: DataFrame, speed: str = "ws", curve: str = "curve", null_as_zero: bool = False) -> DataFrame:
    """Adds power (kW): hours carry their speed and curve.

    specs: curve, rated_power, cut_in, rated_speed, cut_out. A speed beyond the knots, but not beyond cut-in and rated speed,
    follows the first or last piece. Hours of a curve without specification get null, as do null speeds (0 if null_as_zero).
    Hours meet pieces by curve and bin of speed, so no speed is compared with every piece."""
    ends = pieces.groupBy("curve").agg(F.min("x").alias("first"), F.max("x1").alias("end"))
    of = lambda n: F.col(f"__{n}")
    own = lambda table, names: table.select(F.col("curve").alias("__curve"), *[F.col(n).alias(f"__{n}") for n in names])
    known = small(own(specs.join(ends, "curve"), ["rated_power", "cut_in", "rated_speed", "cut_out", "first", "end"]))
    spans = F.explode(F.sequence(F.floor(F.col("x") / BIN), F.floor(F.col("x1") / BIN)))
    dealt = small(own(pieces.withColumn("bin", spans), ["x", "x1", "y", "m", "c", "b", "last", "bin"]))
    ws = F.col(speed)
    rows = df.join(known, F.col(curve) == of("curve"), "left").drop("__curve")
    rows = rows.withColumn("__at", F.when(ws.isNotNull(), F.least(F.greatest(ws, of("first")), of("end")))).withColumn("__of", F.floor(of("at") / BIN))
    here = (of("at") >= of("x")) & ((of("at") < of("x1")) | (of("last") & (of("at") <= of("x1"))))
    met = rows.join(dealt, (F.col(curve) == of("curve")) & (of("of") == of("bin")) & here, "left")
    t, rated = ws - of("x"), of("rated_power").cast("double")
    cubic = F.least(of("y") + t * (of("m") + t * (of("c") + t * of("b"))), rated)
    value = F.when(ws < of("cut_in"), 0.0).when(ws <= of("rated_speed"), cubic).when(ws <= of("cut_out"), rated).when(ws.isNotNull() & rated.isNotNull(), 0.0)
    return met.select(*df.columns, (F.coalesce(value, F.lit(0.0)) if null_as_zero else value).alias("power"))

"""Curves from files, intake of files, stored climatologies and exact percentiles."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galesol.functions import turbines, wind as W
from galesol.operators import climate_store, selection, temporal
from galesol.sources import catalog, curves, intake


def curve_file(folder, name, knots, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text(end.join([f"{name},", "wind_speed,power", *[f"{x},{y}" for x, y in knots], ""]))


def test_a_class_from_a_file_equals_the_literal_one(spark, tmp_path):
    rng = random.Random(2)
    specs = []
    for t in turbines.TURBINES:
        first, power = turbines.CURVES[t.iec_class]
        knots = [(first + turbines.STEP * i, p) for i, p in enumerate(power)]
        rng.shuffle(knots)
        curve_file(tmp_path / "c", t.iec_class, knots, "\r\n" if t.iec_class == "II" else "\n")
        specs.append((t.iec_class, t.rated_power, t.cut_in, t.rated_speed, t.cut_out))
    specs = spark.createDataFrame(specs, "curve string, rated_power int, cut_in double, rated_speed double, cut_out double")
    pieces = curves.cubic_pieces(curves.read_power_curves(spark, str(tmp_path / "c")))
    edges = [x for t in turbines.TURBINES for x in (t.cut_in, t.rated_speed, t.cut_out)]
    speeds = [rng.uniform(0, 30) for _ in range(300)] + edges + [0.0, 1.5, 14.99999, None]
    rows = spark.createDataFrame([(i, t.iec_class, s) for t in turbines.TURBINES for i, s in enumerate(speeds)], "i int, curve string, ws double")
    rows = rows.withColumn("x", F.lit("x")).withColumn("rated_power", F.lit("clash"))
    got = curves.power_by_curve(rows, pieces, specs)
    assert got.columns == [*rows.columns, "power"] and got.count() == rows.count()
    literal = F.coalesce(*[F.when(F.col("curve") == t.iec_class, W.power_output(F.col("ws"), t.iec_class)) for t in turbines.TURBINES])
    assert got.where((F.abs(F.col("power") - literal) > 1e-9) | (F.col("power").isNull() != F.col("ws").isNull())).count() == 0
    zero = curves.power_by_curve(rows, pieces, specs, null_as_zero=True).where("ws IS NULL")
    assert {r["power"] for r in zero.collect()} == {0.0}


def plain_slopes(x, y):
    """Monotone cubic slopes at uneven knots, written out."""
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    if len(d) == 1:
        return [d[0], d[0]]

    def end(h0, d0, h1, d1):
        m = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        return 0.0 if m * d0 <= 0 else 3 * d0 if d0 * d1 <= 0 and abs(m) > 3 * abs(d0) else m

    out = [end(h[0], d[0], h[1], d[1])]
    for k in range(1, len(d)):
        w1, w2 = 2 * h[k] + h[k - 1], h[k] + 2 * h[k - 1]
        out.append(0.0 if d[k - 1] * d[k] <= 0 else (w1 + w2) / (w1 / d[k - 1] + w2 / d[k]))
    return [*out, end(h[-1], d[-1], h[-2], d[-2])]


def test_pieces_of_uneven_knots(spark):
    rng = random.Random(3)
    shapes = {"up": sorted(rng.uniform(0, 100) for _ in range(9)), "flat": [0, 0, 5, 5, 5, 9, 8, 9, 9], "zigzag": [3, 9, 1, 8, 2, 7, 3, 6, 4], "two": [1, 4]}
    knots, want = [], {}
    for name, y in shapes.items():
        x = sorted(rng.uniform(0, 20) for _ in y)
        knots += [(name, a, float(b)) for a, b in zip(x, y)]
        want |= {(name, k): (x[k], y[k], m) for k, m in enumerate(plain_slopes(np.array(x), np.array(y, dtype=float)))}
    knots += [knots[0], ("one", 1.0, 1.0)]
    rng.shuffle(knots)
    for r in curves.cubic_pieces(spark.createDataFrame(knots, "curve string, wind_speed double, power double")).collect():
        x, y, m = want.pop((r["curve"], r["k"]))
        x1, y1, m1 = want[r["curve"], r["k"] + 1] if (r["curve"], r["k"] + 1) in want else (None,) * 3
        assert (r["x"], r["y"], r["m"]) == pytest.approx((x, y, m))
        if x1 is not None:
            h = x1 - x
            assert r["y"] + h * (r["m"] + h * (r["c"] + h * r["b"])) == pytest.approx(y1)
            assert r["m"] + h * (2 * r["c"] + 3 * h * r["b"]) == pytest.approx(m1)
        assert r["last"] == (r["k"] == len(shapes[r["curve"]]) - 2)
    assert {k for _, k in want} == {8, 1}  # the last knots begin no piece


@pytest.mark.parametrize(("few", "bins", "p"), [(3, 64, 37.5), (1, 1024, 90.0), (1000, 1024, 100.0)])
def test_percentiles_of_any_group_are_exact(spark, monkeypatch, few, bins, p):
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "BINS", bins)
    rng = random.Random(6)
    rows = [(None, rng.gauss(0, 1)) for _ in range(500)] + [("same", 2.5)] * 80 + [("two", float(i % 2)) for i in range(90)] + [("one", -7.0)]
    rows += [("wide", s * 10.0 ** rng.randint(-12, 12)) for s in (1, -1) for _ in range(150)] + [("odd", None), ("odd", float("nan")), ("gone", None)]
    rows += [("odd", 3.0), ("inf", float("inf")), ("inf", float("-inf"))] + [("inf", float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r["k"]: r["percentile"] for r in selection.exact_percentile(df, "x", p, ["k"]).collect()}
    groups = {}
    for k, x in rows:
        if x is not None and x == x:
            groups.setdefault(k, []).append(x)
    assert set(got) == set(groups)
    for k, v in groups.items():
        v, at = sorted(v), (len(v) - 1) * p / 100
        lo, hi = v[int(at)], v[min(int(at) + (at > int(at)), len(v) - 1)]
        assert got[k] == pytest.approx(lo if lo == hi else lo + (hi - lo) * (at - int(at)), rel=1e-12)
    if few == 1000:
        assert selection.exact_percentile(df, "x", 0.0, []).first()[0] == float("-inf")
    assert selection.exact_percentile(df.where("false"), "x", 50.0, ["k"]).count() == 0


def test_a_climatology_follows_its_years(spark, tmp_path):
    rng = random.Random(1)
    start = dt.date(2000, 1, 1)
    days = spark.createDataFrame([(c, start + dt.timedelta(days=i), rng.random() if i % 50 else None) for c in range(2) for i in range(0, 2557, 3)], "cell_id int, day date, ws double")
    path, year = str(tmp_path / "clim"), F.year("day")
    climate_store.add_years(days.where(year <= 2003), path, "ws", ["cell_id"])
    for last in (2004, 2005, 2005, 2006):  # one year twice
        got = climate_store.rolling(days.where(year == last), path, "ws", ["cell_id"], 3)
        want = temporal.daily_climatology(days.where(year.between(last - 2, last)), "ws", ["cell_id"]).where("ws IS NOT NULL")
        both = got.withColumnRenamed("ws", "a").join(want, ["cell_id", "month", "dom"], "full")
        assert both.count() > 400 and both.where("a IS NULL OR ws IS NULL OR abs(a - ws) > 1e-12").count() == 0
    assert climate_store.stored_years(spark, path) == list(range(2000, 2007))
    plan = climate_store.climatology(spark, path, "ws", ["cell_id"], (2004, 2006))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    wrong = days.where(year == 2006).withColumn("ws", F.lit(0.0))
    climate_store.add_years(wrong, path, "ws", ["cell_id"])
    assert climate_store.climatology(spark, path, "ws", ["cell_id"], (2006, 2006)).where("ws <> 0").count() == 0


HOURS = "cell_id int, time timestamp, ws double"


def deliver(spark, folder, name, rows):
    spark.createDataFrame(rows, HOURS).coalesce(1).write.parquet(f"{folder}/{name}")


def hourly(day, hours, cells=(0, 1)):
    return [(c, dt.datetime(2024, 1, day, h, 7), float(h)) for c in cells for h in hours]


def test_days_wait_until_they_are_complete(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    desk = intake.Intake(spark, source, str(tmp_path / "desk"), keys=["cell_id"])
    done = lambda: {(r["day"].day, r["n"]) for r in spark.read.parquet(out).groupBy("day").agg(F.count("*").alias("n")).collect()}
    write = lambda rows: catalog.write_indicator(rows, out, "day")
    deliver(spark, source, "a", hourly(1, range(24)) + hourly(2, range(23)))
    assert (desk.take(), desk.take()) == (1, 0)
    assert desk.release(write) == 1 and done() == {(1, 48)}
    assert desk.release(write) == 0
    deliver(spark, source, "b", hourly(2, [23], cells=[0]) + hourly(3, range(24), cells=[0]))
    assert desk.take() == 1 and desk.release(write) == 0  # the other cell still lacks a step, or the whole day
    deliver(spark, source, "c", hourly(2, [23], cells=[1]))
    again = intake.Intake(spark, source, str(tmp_path / "desk"), keys=["cell_id"])  # another process
    assert again.take() == 1 and again.release(write) == 1 and done() == {(1, 48), (2, 48)}
    assert again.manifest().count() == 3 and again.rows().count() == 48 + 46 + 1 + 24 + 1


def test_a_failed_release_comes_again_and_changed_files_are_errors(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    desk = intake.Intake(spark, source, str(tmp_path / "desk"))
    assert desk.due().count() == 0 and desk.release(None) == 0
    deliver(spark, source, "a", hourly(5, range(24)))
    desk.take()

    def fail(rows):
        raise RuntimeError("sink is away")

    with pytest.raises(RuntimeError):
        desk.release(fail)
    assert desk.release(lambda rows: catalog.write_indicator(rows, out, "day")) == 1 and spark.read.parquet(out).count() == 48
    file = next((tmp_path / "in" / "a").glob("*.parquet"))
    import os

    os.utime(file, (1, 1))
    with pytest.raises(ValueError, match="has changed"):
        desk.take()


def test_daily_rows_are_dealt_by_their_number(spark, sf, monkeypatch):
    """A larger table takes more tasks, not larger ones, and what is aggregated by cell goes on in them."""
    from galesol.operators import temporal
    from galesol.sources import fixtures

    want = {tuple(r) for r in fixtures.obs_daily(spark, sf).select("cell_id", "day", "tm").collect()}
    monkeypatch.setattr(fixtures, "PART_ROWS", 300)
    days = fixtures.obs_daily(spark, sf)
    parts = -(-spark.read.parquet(f"{sf}/lineitem.parquet").count() // 300)
    assert parts > 4 and days.rdd.getNumPartitions() == parts
    assert temporal.rescale(days, "ws", "daily", ["cell_id"], "day").rdd.getNumPartitions() == parts
    assert temporal.calendar_pivot(days, "ws", ["cell_id"]).rdd.getNumPartitions() == parts
    assert {tuple(r) for r in days.select("cell_id", "day", "tm").collect()} == want

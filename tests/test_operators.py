import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from galesol.functions import wind as W
from galesol.operators import grid as G, histogram as H, temporal as A
from galesol.sources import catalog, grid as S
from galesol.streaming import indicators


def test_histogram_counts_and_constant_cell(hours):
    h = H.histogram(hours, "ws", ["cell_id"], 10)
    got = {(r["cell_id"], r["bin"]): r for r in h.collect()}
    assert sum(r["count"] for k, r in got.items() if k[0] == 0) == 36
    assert sum(r["count"] for k, r in got.items() if k[0] == 1) == 35
    assert got[1, 0]["lo"] == 6.5 and got[1, 9]["hi"] == 7.5 and got[1, 5]["count"] == 35
    assert got[0, 9]["count"] == 4  # the largest value falls in the last bin
    total = H.density(h, ["cell_id"]).groupBy("cell_id").agg(F.sum(F.col("density") * (F.col("hi") - F.col("lo"))).alias("x"))
    assert [round(r["x"], 9) for r in total.collect()] == [1.0, 1.0]
    packed = H.packed(h, ["cell_id"]).where("cell_id = 0").first()
    assert len(packed["counts"]) == 10 and len(packed["edges"]) == 11


def test_empty_histogram(hours):
    assert H.histogram(hours.where("false"), "ws", ["cell_id"], 10).count() == 0


def test_fill_gaps(hours):
    gap = hours.where("dayofmonth(time) <> 29")
    assert A.rescale(gap, "ws", "daily", ["cell_id"]).count() == 4
    filled = A.rescale(gap, "ws", "daily", ["cell_id"], fill_gaps=True)
    assert filled.count() == 6 and filled.where("ws IS NULL").count() == 2


def test_time_mean_and_counts(hours):
    means = {r["cell_id"]: r["mean"] for r in A.time_mean(hours, "ws", ["cell_id"]).collect()}
    assert means[1] is None and means[0] == 17.5
    assert {r["cell_id"]: r["mean"] for r in A.time_mean(hours, "ws", ["cell_id"], skipna=True).collect()}[1] == 7.0
    counts = {r["cell_id"]: (r["n_hits"], r["n_valid"]) for r in A.count_where(hours, F.col("ws") > 25.0, "ws", ["cell_id"]).collect()}
    assert counts == {0: (10, 36), 1: (0, 35)}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r["x"] for r in G.nan_to_null(df).orderBy("x").collect()] == [None, 1.0]


def test_anomaly_against_itself_is_zero(spark):
    days = spark.createDataFrame([(1, dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(365)], "cell_id int, day date, ws double")
    clim = A.daily_climatology(days, "ws", ["cell_id"]).withColumnRenamed("ws", "base")
    for scale in ("daily", "monthly", "annual"):
        assert A.anomalies(days, clim, "ws", "base", scale, ["cell_id"]).where("abs(anomaly) > 1e-12").count() == 0
    smooth = {(r["month"], r["dom"]): r["ws"] for r in A.climatology_smooth(A.daily_climatology(days, "ws", ["cell_id"]), "ws", ["cell_id"]).collect()}
    assert len(smooth) == 365 and smooth[1, 1] == pytest.approx((364 + 0 + 1) / 3) and smooth[12, 31] == pytest.approx((363 + 364 + 0) / 3)


def test_moving_average_drops_the_first_rows(hours):
    out = A.moving_average(hours.where("cell_id = 0"), "ws", 3, ["cell_id"], ["time"]).orderBy("time").collect()
    assert len(out) == 34 and out[0]["moving"] == 1.0


def grid(spark, lats, lons):
    return spark.createDataFrame([(i, j, lat, lon, 1.0) for i, lat in enumerate(lats) for j, lon in enumerate(lons)], "lat_idx int, lon_idx int, lat double, lon double, ws double")


def test_point_ties_take_the_larger_coordinate(spark):
    df = grid(spark, [10.0, 20.0], [0.0, 10.0])
    got = G.select_point(df, 15.0, 5.0).first()
    assert (got["lat"], got["lon"]) == (20.0, 10.0)


def test_mask_ties_take_the_smaller_and_outside_is_null(spark):
    df = grid(spark, [15.0, 40.0], [5.0])
    mask = grid(spark, [10.0, 20.0], [0.0, 10.0]).withColumn("mask", F.when(F.col("lat_idx") + F.col("lon_idx") == 0, 1.0).otherwise(0.0))
    got = {r["lat"]: r["ws"] for r in G.onshore_mask(df, mask, ["ws"]).collect()}
    assert got == {15.0: 1.0, 40.0: None}


def test_compact_and_scatter(spark):
    df = grid(spark, [1.0, 2.0], [1.0, 2.0])
    mask = df.withColumn("mask", F.when((F.col("lat_idx") == 0) & (F.col("lon_idx") == 1), 0.0).otherwise(1.0)).drop("ws")
    compact = G.mask_compact(df, mask)
    assert sorted(r["cell"] for r in compact.collect()) == [0, 1, 2]
    back = G.mask_scatter(compact.select("cell", "ws"), mask)
    assert back.count() == 4 and back.where("ws IS NULL").select("lat_idx", "lon_idx").first() == (0, 1)


def test_region_ignores_axis_order_and_wrap(spark):
    df = grid(spark, [30.0, 20.0, 10.0], [0.0, 359.0, 180.0])
    assert G.select_region(df, (30.0, 20.0), (0.0, 0.0)).count() == 2
    assert sorted({r[0] for r in df.select(G.wrapped(F.col("lon"))).collect()}) == [-180.0, -1.0, 0.0]


def test_rerun_of_a_day_replaces_it_only(spark, hours):
    days = hours.groupBy("cell_id", F.col("time").cast("date").alias("date")).agg(F.avg("ws").alias("ws"))
    path = catalog.shared_path(spark, "test")
    catalog.write_indicator(days, path)
    catalog.write_indicator(days.where("date = '2024-02-29'").withColumn("ws", F.lit(0.0)), path)
    back = spark.read.parquet(path)
    assert back.count() == 6 and back.where("ws = 0").count() == 2


def test_metadata_and_validation(spark, hours):
    df = S.build_dataset({"ws": hours.select("cell_id", "time", "ws")}, ["cell_id", "time"], {"ws": {"units": "K"}})
    assert S.check_temperature(df, "ws") == "K"
    with pytest.raises(ValueError):
        S.check_temperature(hours, "ws")
    with pytest.raises(ValueError):
        S.require_columns(hours, {"ws": "float"})
    row = S.validate_grid(hours.union(hours.limit(1)), ["cell_id", "time"], ["ws"]).first()
    assert (row["n_rows"], row["n_repeated"], row["null_ws"]) == (73, 1, 1)


def test_capacity_factor_plan_is_one_projection(hours):
    plan = hours.select(*[W.capacity_factor(F.col("ws"), k).alias(k) for k in ("I", "S")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Exchange" not in plan


def test_dense_ids_are_row_major_over_many_tasks(spark):
    cells = [(i, j, float((i * 5 + j) % 3)) for i in range(30) for j in range(20)]
    mask = spark.createDataFrame(cells, "lat_idx int, lon_idx int, mask double").repartition(7)
    got = {(r["lat_idx"], r["lon_idx"]): r["cell"] for r in G.dense_cell_id(mask).collect()}
    assert got == {c: n for n, c in enumerate(sorted((i, j) for i, j, m in cells if m > 0.5))}
    assert G.dense_cell_id(mask.where("false")).count() == 0


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    rows = lambda a, b: spark.range(a, b).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: indicators.run_available(spark.readStream.schema("id long").parquet(str(tmp_path / "in")), "x", folder=str(tmp_path / "out"))
    rows(0, 5)
    assert run().count() == 5
    rows(5, 8)
    assert sorted(r["id"] for r in run().collect()) == list(range(8))


def test_latest_input_is_the_file_modified_last(spark, tmp_path):
    for name, day in (("a", 2), ("b", 3), ("c", 1)):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / name))
        for f in (tmp_path / name).glob("*.parquet"):
            os.utime(f, (day * 86_400, day * 86_400))
    row = catalog.latest_input(spark, f"{tmp_path}/*").first()
    assert f"{tmp_path}/b/" in row["file"] and row["modified"].timestamp() == 3 * 86_400


def test_nearest_axis_agrees_with_all_pairs(spark):
    """Axes of any order and spacing, in and out of reach, with equal coordinates and empty ranges; ties by rule."""
    rng = random.Random(4)
    for size, prefer, reach in ((1, "smaller", False), (7, "larger", True), (40, "smaller", True), (300, "larger", False), (300, "smaller", False)):
        own = [(i, rng.choice([rng.uniform(-50, 50), float(rng.randint(-20, 20)) / 2])) for i in range(120)]
        other = [(i, y) for i, y in enumerate({float(rng.randint(-12, 12)) if rng.random() < 0.7 else rng.uniform(-400, 3) for _ in range(size)})]
        ys = [y for _, y in other]
        want = {}
        for i, x in own:
            if not reach or min(ys) <= x <= max(ys):
                want[i] = min((abs(y - x), y if prefer == "smaller" else -y, j) for j, y in other)[2]
        both = lambda rows: spark.createDataFrame([(n, i, x if x is None or n == "lat" else -x) for n in ("lat", "lon") for i, x in [*rows, (999, None)]], "axis string, idx int, x double").repartition(3)
        near = G.nearest_axes(both(own), both(other), prefer, reach)
        assert {r["lat_idx"]: r["other_lat_idx"] for r in G.axis_map(near, "lat").collect()} == want
        assert set(want) == {r["lon_idx"] for r in G.axis_map(near, "lon").collect()}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert G.nearest_axes(both(own), both([]), "smaller").count() == 0


def test_regridding_repeats_and_reorders_cells(spark):
    df = grid(spark, [10.0, 20.0, 30.0], [0.0, 5.0]).withColumn("ws", F.col("lat") + F.col("lon"))
    lat, lon = spark.createDataFrame([(0, 31.0), (1, 15.0), (2, -90.0)], "i int, x double"), spark.createDataFrame([(0, 2.5), (1, 2.6)], "i int, x double")
    got = {(r["lat"], r["lon"]): r["ws"] for r in G.regrid_nearest(df, lat, lon, ["ws"]).collect()}
    assert got == {(31.0, 2.5): 30.0, (31.0, 2.6): 35.0, (15.0, 2.5): 10.0, (15.0, 2.6): 15.0, (-90.0, 2.5): 10.0, (-90.0, 2.6): 15.0}


def test_small_tables_are_measured_in_bytes(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "id int, name string")
    hinted = lambda d: "BroadcastHashJoin" in df.join(d, "id")._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert hinted(G.small(df)) and sorted(r["id"] for r in G.small(df).collect()) == [1, 2]
        monkeypatch.setattr(G, "SMALL_BYTES", 1000)
        assert not hinted(G.small(df)) and hinted(G.small(df.where("false")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packed_counts_equal_the_long_form(hours):
    rows = hours.withColumn("cf", F.col("ws") / 30.0)
    packed = {(r["cell_id"], i, n) for r in H.packed_counts(rows, "cf", ["cell_id"], 7).collect() for i, n in enumerate(r["counts"])}
    assert packed == {(r["cell_id"], r["bin"], r["count"]) for r in H.fixed_histogram(rows, "cf", ["cell_id"], 7).collect()}
    out = H.packed_counts(rows.where("cell_id = 1").withColumn("cf", F.lit(2.0)), "cf", ["cell_id"], 3).first()
    assert out["counts"] == [0, 0, 0]

"""Period jobs from inputs to named outputs, and layouts by cell."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from galesol import jobs
from galesol.functions import weather
from galesol.operators import temporal
from galesol.sources import catalog, layout

SCHEMA = "time timestamp, lat_idx int, lon_idx int, lat double, lon double, u double, v double, tm double, tx double, tn double, t2m double, g double, ws10 double"


@pytest.fixture
def source(spark, tmp_path):
    """Two by two cells, four days of six-hourly values; one value is NaN."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = []
    for i in range(16):
        for la in range(2):
            for lo in range(2):
                u = float("nan") if (i, la, lo) == (3, 1, 1) else float(i + 2 * la)
                rows.append((dt.datetime(1990, 1, 30) + dt.timedelta(hours=6 * i), la, lo, 40.0 + la, float(lo), u, float(3 * lo), 20.0 + i, 24.0 + i, 18.0 + i, 15.0, 100.0 * i, 4.0))
    path = str(tmp_path / "grid")
    catalog.write_indicator(spark.createDataFrame(rows, SCHEMA).withColumn("date", F.col("time").cast("date")), path)
    return path


@pytest.fixture
def mask(spark):
    """Land but for one cell; the grid lies a tenth of a degree off."""
    return spark.createDataFrame([(i, j, 39.9 + i, j - 0.1, float((i, j) != (0, 1))) for i in range(3) for j in range(3)], "lat_idx int, lon_idx int, lat double, lon double, mask double")


@pytest.mark.parametrize("name", sorted(jobs.INDICATORS))
def test_every_indicator_runs_with_and_without_mask(spark, tmp_path, source, mask, name):
    spec, out = jobs.INDICATORS[name], str(tmp_path / "out")
    clim = spark.createDataFrame([(la, lo, m, d, 1.0) for la in range(2) for lo in range(2) for m in (1, 2) for d in range(1, 32)], "lat_idx int, lon_idx int, month int, dom int, base double")
    for side in (None, mask):
        row = jobs.run_period(spark, source, name, "1990-01-31", "1990-02-01", out, side, clim if name == "wind_speed_anomalies" else None).first()
        assert row["name"] == f"1990_01_31_T00_00_{spec.short}" and row["mask"] == ("no" if side is None else "yes")
        written = spark.read.parquet(f"{out}/{spec.short}")
        assert row["n_rows"] == written.count() == (4 if spec.event else 8 if name == "wind_speed_anomalies" else 32)
        assert (row["min_lat"], row["max_lat"], row["min_lon"], row["max_lon"]) == (40.0, 41.0, 0.0, 1.0)
        sea = written.where("lat_idx = 0 AND lon_idx = 1").where(F.col(spec.short).isNotNull()).count()
        assert (sea == 0) == (side is not None)
        assert written.where("lat_idx = 0 AND lon_idx = 0").where(F.col(spec.short).isNull()).count() == 0
    assert spark.read.parquet(f"{out}/catalog").count() == 1  # the second run replaced the first


def test_a_run_replaces_its_dates_only(spark, tmp_path, source):
    out = str(tmp_path / "out")
    jobs.run_period(spark, source, "wind_direction", "1990-01-30", "1990-02-02", out)
    before = spark.read.parquet(f"{out}/wd").count()
    jobs.run_period(spark, source, "wind_direction", "1990-02-01", "1990-02-01", out, message="again")
    assert spark.read.parquet(f"{out}/wd").count() == before == 64
    runs = {r["name"]: r["history"] for r in spark.read.parquet(f"{out}/catalog").collect()}
    assert set(runs) == {"1990_01_30_T00_00_wd", "1990_02_01_T00_00_wd"} and runs["1990_02_01_T00_00_wd"].endswith("again")


def test_empty_periods_and_wrong_inputs(spark, tmp_path, source):
    out = str(tmp_path / "out")
    assert jobs.run_period(spark, source, "cdd", "1995-01-01", "1995-01-02", out).count() == 0
    with pytest.raises(KeyError):
        jobs.run_period(spark, source, "no such thing", "1990-01-31", "1990-02-01", out)
    with pytest.raises(ValueError, match="climatology"):
        jobs.run_period(spark, source, "wind_speed_anomalies", "1990-01-31", "1990-02-01", out)
    with pytest.raises(ValueError, match="missing"):
        jobs.indicator_of(spark.read.parquet(source).drop("u"), "wind_direction")


def test_masked_values_and_counts_as_zero(spark, source, mask):
    rows = spark.read.parquet(source)
    values = jobs.indicator_of(rows, "cdd", mask, null_as_zero=True)
    assert values.where("cdd IS NULL").count() == 0 and values.where("lat_idx = 0 AND lon_idx = 1 AND cdd <> 0").count() == 0
    events = {(r["lat_idx"], r["lon_idx"]): (r["n_valid"], r["lwe"]) for r in jobs.indicator_of(rows, "low_wind_events", mask, null_as_zero=True).collect()}
    own = lambda la, lo: [math.hypot(i + 2 * la, 3 * lo) for i in range(16) if (i, la, lo) != (3, 1, 1)]
    assert events == {(la, lo): (0, 0) if (la, lo) == (0, 1) else (len(own(la, lo)), sum(s < 3 for s in own(la, lo))) for la in range(2) for lo in range(2)}
    nothing = spark.createDataFrame([(None, 1.0, 1.0)], "tm double, tx double, tn double")
    both = nothing.select(weather.heating_degree_days(F.col("tm"), F.col("tx"), F.col("tn")).alias("a"), weather.heating_degree_days(F.col("tm"), F.col("tx"), F.col("tn"), null_as_zero=True).alias("b")).first()
    assert tuple(both) == (None, 0.0)


def test_laid_out_tables_meet_without_an_exchange(spark):
    start = dt.date(2023, 1, 1)
    days = spark.createDataFrame([(c, start + dt.timedelta(days=i), float(i + c), float(i * c)) for c in range(6) for i in range(40)], "cell_id int, day date, a double, b double")
    clim = temporal.daily_climatology(days, "a", ["cell_id"]).withColumnRenamed("a", "base")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (layout.lay_out(days.select("cell_id", "day", x), 4, ["cell_id"], ["day"]) for x in "ab")
        base = layout.lay_out(clim, 4, ["cell_id"], ["month", "dom"])
        with layout.joined_by_cell(spark):
            joined = temporal.climatology_join(a.join(b, ["cell_id", "day"]), base, ["cell_id"])
            out = temporal.moving_average(joined, "a", 3, ["cell_id"], ["day"])
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
            assert joined.count() == 240 and joined.where("a <> base").count() == 0
            per = a.groupBy("cell_id", F.month("day")).agg(F.avg("a"))
            assert "Exchange" not in per._jdf.queryExecution().executedPlan().toString()
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

"""Streams with state, late rows and side tables against their batch results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from galesol.operators import histogram as H
from galesol.sources import catalog
from galesol.streaming import indicators as I, monthly, restate, weekly

SCHEMA = "cell_id int, time timestamp, cf double"
START = dt.datetime(2024, 1, 1)


def rows_of(days, seed=1, cells=3, step=6):
    rng = random.Random(seed)
    return [(c, START + dt.timedelta(hours=step * i), rng.random()) for c in range(cells) for i in range(days * 24 // step)]


def put(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, path, files=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(str(path))


def months_of(rows, closed_by):
    want = {}
    for c, t, x in rows:
        end = dt.datetime(t.year + t.month // 12, t.month % 12 + 1, 1)
        if end <= closed_by:
            key = (c, dt.date(t.year, t.month, 1), min(int(x * 10), 9))
            want[key] = want.get(key, 0) + 1
    return want


def test_months_come_out_once_and_go_on_after_a_restart(spark, tmp_path):
    rows = rows_of(100)
    first = [r for r in rows if r[1] < dt.datetime(2024, 2, 17)]
    second = [r for r in rows if dt.datetime(2024, 2, 17) <= r[1] < dt.datetime(2024, 3, 20)]
    third = [r for r in rows if r[1] >= dt.datetime(2024, 3, 20)]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    edges = [(0, dt.datetime(2024, 1, 31, 23, 59, 59, 999000), 1.0), (1, dt.datetime(2024, 2, 1), 0.0), (2, dt.datetime(2024, 2, 2), None), (2, dt.datetime(2024, 2, 2), 7.0)]
    seen = []
    for part in (first + edges[:1], second, third):
        put(spark, part, tmp_path / "in")
        out = I.run_available(monthly.stream_month_histogram(stream(spark, tmp_path / "in"), "cf", ["cell_id"], 10), "m", folder=str(tmp_path / "out"), timers=True)
        got = {(r["cell_id"], r["month"], r["bin"]): r["count"] for r in out.collect()}
        assert out.count() == len(got)
        seen += [r for r in part if r[2] is not None]
        want = months_of(seen, max(r[1] for r in seen) - dt.timedelta(days=1))
        assert {k: n for k, n in got.items() if n} == want
        assert len(got) == 10 * len({k[:2] for k in want})
    assert {k[1] for k in want} == {dt.date(2024, m, 1) for m in (1, 2, 3)}
    # A row of a month that is over is late: it neither comes out nor brings the month back.
    put(spark, [(0, dt.datetime(2024, 1, 5), 0.5), (0, dt.datetime(2024, 4, 10), 0.5)], tmp_path / "in")
    again = I.run_available(monthly.stream_month_histogram(stream(spark, tmp_path / "in"), "cf", ["cell_id"], 10), "m", folder=str(tmp_path / "out"), timers=True)
    assert again.where("month < '2024-04-01'").count() == len(got)


def test_null_and_outlying_values_are_no_month(spark, tmp_path):
    put(spark, [(2, dt.datetime(2024, 2, 2), None), (2, dt.datetime(2024, 2, 2), 7.0), (1, dt.datetime(2024, 4, 2), 0.5)], tmp_path / "in")
    out = I.run_available(monthly.stream_month_histogram(stream(spark, tmp_path / "in"), "cf", ["cell_id"], 10), "m", folder=str(tmp_path / "out"), timers=True)
    assert out.count() == 0


def per_day(rows):
    return rows.groupBy("cell_id", "day").agg(F.count("*").alias("n"), F.sum("cf").alias("total"))


def days_of(spark, rows, closed_by):
    days = spark.createDataFrame(rows, SCHEMA).withColumn("day", F.col("time").cast("date"))
    return {(r["cell_id"], r["day"], r["n"], round(r["total"], 9)) for r in per_day(days).collect() if dt.datetime.combine(r["day"], dt.time()) + dt.timedelta(days=1) <= closed_by}


def published(days):
    return {(r["cell_id"], r["day"], r["n"], round(r["total"], 9)) for r in days.daily().collect()}


def test_late_rows_restate_their_days_only(spark, tmp_path):
    rows = rows_of(12, seed=3)
    random.Random(9).shuffle(rows)
    days = restate.Restated(spark, per_day, str(tmp_path / "out"))
    for at in range(0, len(rows), 40):
        put(spark, rows[at : at + 40], tmp_path / "in")
        days.run(stream(spark, tmp_path / "in", 1))
        seen = rows[: at + 40]
        assert published(days) == days_of(spark, seen, max(r[1] for r in seen) - dt.timedelta(days=1))
    late = days.late()
    assert late.count() > 40 and late.where("date_add(day, 1) > '2024-01-12'").count() == 0
    # A late row of one day: that day's files are new, all others are the ones that were there.
    files = lambda: {(r["day"], r["f"]) for r in days.daily().select("day", F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    put(spark, [(0, START + dt.timedelta(days=2, hours=1), 0.25)], tmp_path / "in")
    days.run(stream(spark, tmp_path / "in", 1))
    assert {d for d, _ in before ^ files()} == {dt.date(2024, 1, 3)}
    assert published(days) == days_of(spark, [*rows, (0, START + dt.timedelta(days=2, hours=1), 0.25)], max(r[1] for r in rows) - dt.timedelta(days=1))


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    rows = rows_of(9, seed=4)
    days = restate.Restated(spark, per_day, str(tmp_path / "out"))
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    days.take(frame(rows[::2]), 0)
    days.take(frame(rows[1::2]), 1)
    want, late = published(days), days.late().count()
    days.take(frame(rows[1::2]), 1)
    assert published(days) == want == days_of(spark, rows, max(r[1] for r in rows) - dt.timedelta(days=1)) and days.late().count() == late > 0
    days.take(frame([]), 2)
    days.take(frame([(1, None, 0.5)]), 3)
    assert published(days) == want


def test_weeks_are_published_when_they_close(spark, tmp_path):
    rows = rows_of(31, seed=5)
    out = str(tmp_path / "out")
    for part in ([r for r in rows if r[1] < dt.datetime(2024, 1, 11)], [r for r in rows if r[1] >= dt.datetime(2024, 1, 11)]):
        put(spark, part, tmp_path / "in")
        weeks = weekly.publish_weeks(weekly.stream_weeks(stream(spark, tmp_path / "in"), "cf", ["cell_id"]), folder=out)
        raw = I.run_available(I.stream_raw_by_week(stream(spark, tmp_path / "in")), "raw", ["week"], folder=str(tmp_path / "raw"))
    got = {(r["cell_id"], r["week"]): r for r in weeks.collect()}
    sundays = [dt.date(2024, 1, d) for d in (7, 14, 21, 28)]
    assert set(got) == {(c, w) for c in range(3) for w in sundays}
    for (c, week), r in got.items():
        own = [x for d, t, x in rows if d == c and week - dt.timedelta(days=6) <= t.date() <= week]
        assert (r["n"], r["n_days"], r["max"], r["min"]) == (28, 7, max(own), min(own)) and r["mean"] == pytest.approx(sum(own) / 28)
    listed = weekly.week_catalog(spark, out).collect()
    assert sorted(r["week"] for r in listed) == sundays and {r["n"] for r in listed} == {84} and len({r["batch"] for r in listed}) > 1
    assert weekly.released(raw, weekly.week_catalog(spark, out)).count() == 4 * 84 < raw.count()


def test_masked_counts_hold_their_version(spark, tmp_path):
    rows = [(c, t, 30.0 if i % 5 == 0 else 1.0) for i, (c, t, _) in enumerate(rows_of(6))]
    put(spark, rows, tmp_path / "in")
    masks = str(tmp_path / "masks")
    mask = lambda *on: spark.createDataFrame([(c, float(c in on)) for c in range(3)], "cell_id int, mask double")
    assert (catalog.publish_version(mask(0), masks), catalog.publish_version(mask(1, 2), masks)) == (1, 2)
    for version, cells in ((None, {1, 2}), (1, {0})):
        side = catalog.read_version(spark, masks, version)
        out = I.run_available(I.stream_masked_event_counts(stream(spark, tmp_path / "in"), side, "cf", ["cell_id"], ["cell_id"]), "c", folder=str(tmp_path / f"out{version}"))
        batch = {(c, t.date()) for c, t, _ in rows if c in cells and t.date() < dt.date(2024, 1, 5)}
        got = out.collect()
        assert {(r["cell_id"], r["day"]) for r in got} == batch and {r["version"] for r in got} == {version or 2}
        for r in got:
            own = [x for c, t, x in rows if c == r["cell_id"] and t.date() == r["day"]]
            assert (r["n_high"], r["n_low"]) == (sum(x > 25 for x in own), sum(x < 3 for x in own))


def test_fixed_histogram_of_months_equals_the_stream(spark, tmp_path):
    """The batch operator and the stateful stream agree bin by bin."""
    rows = rows_of(70, seed=8)
    put(spark, rows, tmp_path / "in")
    out = I.run_available(monthly.stream_month_histogram(stream(spark, tmp_path / "in"), "cf", ["cell_id"], 30), "m", folder=str(tmp_path / "out"), timers=True)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("month", F.trunc(F.col("time").cast("date"), "month")).where("month < '2024-03-01'")
    batch = H.fixed_histogram(frame, "cf", ["cell_id", "month"], 30).select("cell_id", "month", "bin", "count")
    assert sorted(map(tuple, out.select("cell_id", "month", "bin", "count").collect())) == sorted(map(tuple, batch.collect()))


def test_months_of_many_cells_take_no_step_per_cell(spark, tmp_path):
    """Months close a day behind their end, over a leap February and the turn of a year; no Python runs for a cell."""
    times = [dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 29, 12), dt.datetime(2024, 3, 1, 23, 59, 59)]
    put(spark, [(c, t, 0.5) for c in range(500) for t in times], tmp_path / "in")
    months = monthly.stream_month_histogram(stream(spark, tmp_path / "in"), "cf", ["cell_id"], 10)
    assert "Python" not in months._jdf.queryExecution().analyzed().toString() and "InPandas" not in months._jdf.queryExecution().analyzed().toString()
    run = lambda: I.run_available(months, "m", folder=str(tmp_path / "out"), timers=True).groupBy("month").agg(F.sum("count").alias("n"), F.count("*").alias("rows")).collect()
    assert {tuple(r) for r in run()} == {(dt.date(2023, 12, 1), 500, 5000), (dt.date(2024, 1, 1), 500, 5000)}
    put(spark, [(0, dt.datetime(2024, 3, 2), 0.5)], tmp_path / "in")
    assert {tuple(r) for r in run()} == {(dt.date(2023, 12, 1), 500, 5000), (dt.date(2024, 1, 1), 500, 5000), (dt.date(2024, 2, 1), 500, 5000)}

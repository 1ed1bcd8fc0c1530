import datetime as dt

import pytest
from pyspark.sql import functions as F

from galesol.functions import turbines as U, weather as T, wind as W
from galesol.functions.calendar import calendar_bin

#: Power in kW between knots, from an independent evaluation of the published formula.
ANCHORS = {"I": {5.25: 153.4163, 9.8: 1155.7543, 15.3: 2300.0}, "I_II": {5.25: 137.0661, 9.8: 1235.8843}, "II": {5.25: 182.6011, 9.8: 1402.9139}, "II_III": {5.25: 317.4140, 9.8: 1825.0456}, "III": {5.25: 244.8939, 9.8: 1874.4290}, "S": {5.25: 746.2793, 9.8: 5610.0128}}


def values(spark, xs, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, ws double").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("iec", sorted(ANCHORS))
def test_power_curve_anchors(spark, iec):
    got = values(spark, list(ANCHORS[iec]), W.power_output(F.col("ws"), iec))
    assert got == pytest.approx(list(ANCHORS[iec].values()), abs=2e-3)


@pytest.mark.parametrize("iec", [t.iec_class for t in U.TURBINES])
def test_branch_edges_and_bounds(spark, iec):
    t = U.turbine(iec)
    eps = 1e-9
    got = values(spark, [0.0, t.cut_in - eps, t.rated_speed, t.rated_speed + eps, t.cut_out, t.cut_out + eps, None], W.power_output(F.col("ws"), iec))
    assert got[0] == got[1] == 0.0 and got[3] == got[4] == t.rated_power and got[5] == 0.0 and got[6] is None
    assert got[2] <= t.rated_power
    cf = values(spark, [i / 10 for i in range(300)], W.capacity_factor(F.col("ws"), iec))
    assert all(0.0 <= x <= 1.0 for x in cf)


def test_null_as_zero(spark):
    assert values(spark, [None], W.capacity_factor(F.col("ws"), "I", null_as_zero=True)) == [0.0]


def test_class_names():
    assert U.turbine("I/II").iec_class == "I_II"
    with pytest.raises(ValueError):
        U.turbine("IV")


def test_cubic_passes_through_knots():
    for iec, (first, power) in U.CURVES.items():
        for k, p in enumerate(U.pieces(iec)):
            t = U.STEP
            assert p.y == power[k] and p.y + t * (p.m + t * (p.c + t * p.b)) == pytest.approx(power[k + 1])


def test_direction(spark):
    rows = [(0.0, 0.0, 180.0), (-0.0, -0.0, 180.0), (0.0, -1.0, 0.0), (-1.0, 0.0, 90.0), (0.0, 1.0, 180.0), (1.0, 0.0, 270.0)]
    df = spark.createDataFrame(rows, "u double, v double, want double")
    for r in df.select("want", W.wind_direction(F.col("u"), F.col("v")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["want"])


def test_degree_days(spark):
    rows = [(20.0, 21.0, 19.0, 0.0, 0.0), (21.0, 24.0, 18.0, 0.5, 0.0), (25.0, 28.0, 20.0, 2.5, 0.0), (27.0, 30.0, 23.0, 5.0, 0.0), (10.0, 15.5, 5.0, 0.0, 5.5), (15.0, 17.0, 12.0, 0.0, 1.375), (16.0, 18.0, 14.0, 0.0, 0.375), (None, 1.0, 0.0, None, None)]
    df = spark.createDataFrame(rows, "tm double, tx double, tn double, c double, h double")
    t = [F.col(n) for n in ("tm", "tx", "tn")]
    for r in df.select("c", "h", T.cooling_degree_days(*t).alias("cdd"), T.heating_degree_days(*t).alias("hdd")).collect():
        assert (r["cdd"], r["hdd"]) == ((None, None) if r["c"] is None else (pytest.approx(r["c"]), pytest.approx(r["h"])))


def test_night_is_null_and_noon_is_high(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 6, 21, 12), 45.0, 0.0), (dt.datetime(2024, 6, 21, 0), 45.0, 0.0)], "t timestamp, lat double, lon double")
    noon, night = [r[0] for r in df.orderBy(F.desc("t")).select(T.cosine_sza(F.col("t"), F.col("lat"), F.col("lon"))).collect()]
    assert noon == pytest.approx(0.93, abs=0.01) and night is None


@pytest.mark.parametrize(
    "scale,day,label",
    [("weekly", "2024-01-01", "2024-01-07"), ("weekly", "2024-01-07", "2024-01-07"), ("monthly", "2024-02-01", "2024-02-29"), ("annual", "2023-01-01", "2023-12-31"), ("seasonal", "2024-02-29", "2023-12-01"), ("seasonal", "2024-03-01", "2024-03-01"), ("seasonal", "2023-12-31", "2023-12-01"), ("daily", "2023-12-31", "2023-12-31")],
)
def test_calendar_labels(spark, scale, day, label):
    df = spark.sql(f"SELECT TIMESTAMP '{day} 13:00:00' AS t")
    assert str(df.select(calendar_bin(F.col("t"), scale)).first()[0]) == label


class _Any:
    def cast(self, _):
        return self


def test_calendar_scale_is_checked():
    with pytest.raises(ValueError):
        calendar_bin(_Any(), "None")

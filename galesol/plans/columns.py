"""Queries of projections, filters and column formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.functions import weather as T, wind as W
from galesol.functions.calendar import is_leap_day
from galesol.functions.turbines import TURBINES, pieces
from galesol.operators import grid as G
from galesol.plans.registry import query, r
from galesol.sources.fixtures import dim_mask, obs_daily, obs_hourly, rounded

c = F.col
CALM = "(CASE WHEN u = 0 AND v = 0 THEN 180e0 ELSE (degrees(atan2(-u, -v)) + 360e0) % 360e0 END)"


def power_sql(source: str, classes: list[str]) -> str:
    """SQL for (event_id, iec_class, power): the cubic pieces as a VALUES table."""
    rows = ", ".join(f"('{k}', {i}, {p.x!r}::DOUBLE, {p.y!r}::DOUBLE, {p.m!r}::DOUBLE, {p.c!r}::DOUBLE, {p.b!r}::DOUBLE)" for k in classes for i, p in enumerate(pieces(k)))
    specs = ", ".join(f"('{t.iec_class}', {t.rated_power}::DOUBLE, {t.cut_in!r}::DOUBLE, {t.rated_speed!r}::DOUBLE, {t.cut_out!r}::DOUBLE, {pieces(t.iec_class)[0].x!r}::DOUBLE, {len(pieces(t.iec_class)) - 1})" for t in TURBINES if t.iec_class in classes)
    return f"""SELECT o.*, s.iec_class, s.rated, CASE WHEN ws < s.cut_in THEN 0e0
  WHEN ws <= s.rated_speed THEN least(y + (ws - x) * (m + (ws - x) * (c + (ws - x) * b)), s.rated) WHEN ws <= s.cut_out THEN s.rated ELSE 0e0 END AS power
  FROM {source} o CROSS JOIN (VALUES {specs}) s(iec_class, rated, cut_in, rated_speed, cut_out, x0, last)
  JOIN (VALUES {rows}) p(iec_class, k, x, y, m, c, b) ON p.iec_class = s.iec_class AND p.k = least(greatest(floor((ws - s.x0) / 5e-1), 0), s.last)"""


CLASSES = [t.iec_class for t in TURBINES]
KEY = ["event_id", "cell_id"]


@query("SELECT event_id, cell_id, u, v FROM (SELECT *, event_id % 2 AS level_idx FROM obs_hourly) WHERE level_idx = 0")
def level_squeeze(spark: SparkSession, d: str) -> DataFrame:
    return G.level_squeeze(obs_hourly(spark, d).withColumn("level_idx", c("event_id") % 2)).select(*KEY, "u", "v")


@query("SELECT event_id, cell_id, lat_idx, lon_idx FROM obs_hourly WHERE lat_idx >= 1 AND lon_idx < (SELECT max(lon_idx) FROM obs_hourly)")
def edge_trim(spark: SparkSession, d: str) -> DataFrame:
    return G.edge_trim(obs_hourly(spark, d)).select(*KEY, "lat_idx", "lon_idx")


@query(f"SELECT event_id, cell_id, {r('27e0 + coalesce(45e0 * lat_idx / nullif((SELECT max(lat_idx) FROM obs_hourly), 0), 0e0)')} AS lat FROM obs_hourly")
def relabel_lat(spark: SparkSession, d: str) -> DataFrame:
    return G.relabel_lat(obs_hourly(spark, d)).select(*KEY, rounded(c("lat")).alias("lat"))


@query("SELECT event_id, cell_id, lat, lon FROM obs_hourly WHERE lat BETWEEN 35 AND 50 AND lon BETWEEN 0 AND 21")
def select_region(spark: SparkSession, d: str) -> DataFrame:
    return G.select_region(obs_hourly(spark, d), (50.0, 35.0), (0.0, 21.0)).select(*KEY, "lat", "lon")


@query("SELECT event_id, cell_id, ((lon + 180e0) % 360e0) - 180e0 AS lon FROM obs_hourly")
def wrap_longitude(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, G.wrapped(c("lon")).alias("lon"))


@query(f"SELECT cell_id, day, {r('tm')} AS tm FROM obs_daily WHERE NOT (month(day) = 2 AND day(day) = 29)")
def drop_leap_day(spark: SparkSession, d: str) -> DataFrame:
    return obs_daily(spark, d).where(~is_leap_day(c("day"))).select("cell_id", "day", rounded(c("tm")).alias("tm"))


@query(f"SELECT cell_id, day, {r('tm')} AS tm FROM obs_daily WHERE day >= DATE '1995-12-01' AND day < DATE '1996-03-01'")
def season_subset(spark: SparkSession, d: str) -> DataFrame:
    days = obs_daily(spark, d).where((c("day") >= F.lit("1995-12-01").cast("date")) & (c("day") < F.lit("1996-03-01").cast("date")))
    return days.select("cell_id", "day", rounded(c("tm")).alias("tm"))


@query("SELECT event_id, cell_id FROM obs_hourly SEMI JOIN (SELECT n_nationkey FROM nation WHERE n_name LIKE '%1') n ON (cell_id % 25) = n_nationkey")
def country_filter(spark: SparkSession, d: str) -> DataFrame:
    flags = spark.read.parquet(f"{d}/nation.parquet").where("n_name LIKE '%1'").select(c("n_nationkey").alias("flag"))
    rows = obs_hourly(spark, d).withColumn("flag", (c("cell_id") % 25).cast("long"))
    return rows.join(G.small(flags), "flag", "left_semi").select(*KEY)


@query(f"SELECT event_id, cell_id, {r('sqrt(u * u + v * v)')} AS ws FROM obs_hourly")
def wind_speed(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.wind_speed(c("u"), c("v"))).alias("ws"))


@query(f"SELECT event_id, cell_id, {r(CALM)} AS direction FROM obs_hourly")
def wind_direction(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.wind_direction(c("u"), c("v"))).alias("direction"))


@query(f"SELECT event_id, cell_id, {r('t2m_k - 273.15e0')} AS t2m FROM obs_hourly")
def convert_temperature(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(T.convert_temperature(c("t2m_k"))).alias("t2m"))


@query("SELECT cell_id, CASE WHEN min(t2m_k) > 100 THEN 'K' WHEN max(t2m_k) < 100 THEN 'C' END AS unit FROM obs_hourly GROUP BY cell_id")
def check_temperature(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).groupBy("cell_id").agg(T.temperature_unit(F.min("t2m_k"), F.max("t2m_k")).alias("unit"))


@query(f"SELECT event_id, cell_id, {r('CASE WHEN event_id % 2 = 0 THEN g / 3600e0 ELSE g END')} AS g FROM obs_hourly")
def convert_radiation(spark: SparkSession, d: str) -> DataFrame:
    unit = F.when(c("event_id") % 2 == 0, "J m**-2").otherwise("W m**-2")
    return obs_hourly(spark, d).select(*KEY, rounded(T.convert_radiation(c("g"), unit)).alias("g"))


@query(f"SELECT event_id, cell_id, {r('5e-1 * 1.225e0 * ws * ws * ws')} AS wpd FROM obs_hourly")
def wind_power_density(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.wind_power_density(c("ws"))).alias("wpd"))


@query(f"SELECT event_id, cell_id, {r('sqrt(u * u + v * v) * power(8.5e0, 1.43e-1)')} AS ws FROM obs_hourly")
def wind_speed_at_height(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.wind_speed_at_height(c("u"), c("v"), 85.0)).alias("ws"))


@query(f"SELECT event_id, cell_id, {r('power')} AS power FROM p", p=power_sql("obs_hourly", ["I"]))
def power_output(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.power_output(c("ws"), "I")).alias("power"))


_PIVOT = ", ".join(f"max(CASE WHEN iec_class = '{k}' THEN {r('power / rated')} END) AS cf_{k.lower()}" for k in CLASSES)


@query(f"SELECT event_id, cell_id, {_PIVOT} FROM p GROUP BY event_id, cell_id", p=power_sql("obs_hourly", CLASSES))
def capacity_factor(spark: SparkSession, d: str) -> DataFrame:
    """All classes in one pass over the speeds."""
    return obs_hourly(spark, d).select(*KEY, *[rounded(W.capacity_factor(c("ws"), k)).alias(f"cf_{k.lower()}") for k in CLASSES])


def _one_class(iec: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return obs_hourly(spark, d).select(*KEY, rounded(W.capacity_factor(c("ws"), iec)).alias("cf"))

    query(f"SELECT event_id, cell_id, {r('power / rated')} AS cf FROM p", name=f"capacity_factor_{iec.lower()}", p=power_sql("obs_hourly", [iec]))(run)


for _iec in ("I", "II", "III", "S"):
    _one_class(_iec)

_WEIBULL = "CASE WHEN ws < 3e0 THEN 0e0 WHEN ws <= 1.4e1 THEN 2e3 * (1 - exp(-power(ws * alfa, k))) WHEN ws <= cut_out THEN 2e3 ELSE 0e0 END"
_SCENARIOS = [("base", 0.1, 4.0, 25.0), ("alfa-", 0.095, 4.0, 25.0), ("alfa+", 0.105, 4.0, 25.0), ("k-", 0.1, 3.9, 25.0), ("k+", 0.1, 4.1, 25.0), ("out-1", 0.1, 4.0, 24.0), ("out-2", 0.1, 4.0, 23.0)]
_SCENARIO_ROWS = ", ".join(f"('{n}', {a!r}::DOUBLE, {k!r}::DOUBLE, {o!r}::DOUBLE)" for n, a, k, o in _SCENARIOS)


def _scenarios(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(_SCENARIOS, "scenario string, alfa double, k double, cut_out double"))  # seven rows


def _weibull(alfa, k, out):
    return W.weibull_power(c("ws"), F.lit(2000.0), F.lit(3.0), F.lit(14.0), out, alfa, k)


@query(f"SELECT event_id, cell_id, {r(_WEIBULL)} AS power FROM (SELECT *, 1e-1 AS alfa, 4e0 AS k, 2.5e1 AS cut_out FROM obs_hourly)")
def weibull_power(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(_weibull(F.lit(0.1), F.lit(4.0), F.lit(25.0))).alias("power"))


@query(f"SELECT cell_id, scenario, {r(f'avg({_WEIBULL}) / 2e3')} AS cf FROM obs_hourly CROSS JOIN (VALUES {_SCENARIO_ROWS}) s(scenario, alfa, k, cut_out) GROUP BY cell_id, scenario")
def curve_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    rows = obs_hourly(spark, d).crossJoin(_scenarios(spark))
    return rows.groupBy("cell_id", "scenario").agg(rounded(F.avg(_weibull(c("alfa"), c("k"), c("cut_out"))) / 2000.0).alias("cf"))


@query(f"SELECT event_id, cell_id, scenario, ws FROM obs_hourly CROSS JOIN (VALUES {_SCENARIO_ROWS}) s(scenario, alfa, k, cut_out)")
def scenario_cross(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).crossJoin(_scenarios(spark)).select(*KEY, "scenario", "ws")


@query(f"SELECT event_id, cell_id, {r('power / rated * 2.3e0 * 10')} AS aep FROM p", p=power_sql("obs_hourly", ["I"]))
def annual_energy_production(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(W.energy_production(W.capacity_factor(c("ws"), "I"), 2300.0, 10)).alias("aep"))


CDD = "(CASE WHEN tm <= 2.2e1 AND 2.2e1 < tx THEN (tx - 2.2e1) / 4 ELSE 0e0 END + CASE WHEN tn <= 2.2e1 AND 2.2e1 < tm THEN (tx - 2.2e1) / 2 - (2.2e1 - tn) / 4 ELSE 0e0 END + CASE WHEN 2.2e1 < tn THEN tm - 2.2e1 ELSE 0e0 END)"
HDD = "(CASE WHEN 1.55e1 >= tx THEN 1.55e1 - tm ELSE 0e0 END + CASE WHEN tm <= 1.55e1 AND 1.55e1 < tx THEN (1.55e1 - tn) / 2 - (tx - 1.55e1) / 4 ELSE 0e0 END + CASE WHEN tn <= 1.55e1 AND 1.55e1 < tm THEN (1.55e1 - tn) / 4 ELSE 0e0 END)"


@query(f"SELECT cell_id, day, {r(CDD)} AS cdd FROM obs_daily")
def cooling_degree_days(spark: SparkSession, d: str) -> DataFrame:
    return obs_daily(spark, d).select("cell_id", "day", rounded(T.cooling_degree_days(c("tm"), c("tx"), c("tn"))).alias("cdd"))


@query(f"SELECT cell_id, day, {r(HDD)} AS hdd FROM obs_daily")
def heating_degree_days(spark: SparkSession, d: str) -> DataFrame:
    return obs_daily(spark, d).select("cell_id", "day", rounded(T.heating_degree_days(c("tm"), c("tx"), c("tn"))).alias("hdd"))


_PV = "1.1035e-3 * g + 1.4e-7 * g * g - 4.715e-6 * g * (t2m_k - 273.15e0) + 7.64e-6 * g * ws"


@query(f"SELECT event_id, cell_id, {r(_PV)} AS pv FROM obs_hourly")
def pv_potential(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).select(*KEY, rounded(T.pv_potential(T.convert_temperature(c("t2m_k")), c("g"), c("ws"))).alias("pv"))


_SUN = """SELECT *, sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(radians(15 * ((hour(time) * 60 + minute(time) + 4 * lon
  + 9.87e0 * sin(2 * b) - 7.53e0 * cos(b) - 1.5e0 * sin(b)) / 6e1 - 12))) AS cz FROM (SELECT c.*, s.time, dayofyear(s.time) * (2 * pi() / 365e0) AS b,
  radians(23.45e0 * sin((dayofyear(s.time) - 81) * (2 * pi() / 365e0))) AS dec FROM dim_mask c
  CROSS JOIN (SELECT unnest(generate_series(date_trunc('hour', min(time)), date_trunc('hour', max(time)), INTERVAL 1 HOUR)) AS time FROM obs_hourly) s)"""


@query(f"SELECT lat_idx, lon_idx, time, {r('CASE WHEN cz > 0 THEN least(cz, 1e0) END')} AS cos_sza FROM sun", sun=_SUN)
def cosine_sza(spark: SparkSession, d: str) -> DataFrame:
    """Hours of the observed span by cells of the mask."""
    span = obs_hourly(spark, d).agg(F.date_trunc("hour", F.min("time")).alias("a"), F.date_trunc("hour", F.max("time")).alias("b"))
    hours = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("time"))
    rows = dim_mask(spark, d).crossJoin(G.small(hours))
    return rows.select("lat_idx", "lon_idx", "time", rounded(T.cosine_sza(c("time"), c("lat"), c("lon"))).alias("cos_sza"))


@query(f"SELECT cell_id, {r('sum(CASE WHEN ws < 3e0 THEN 1 ELSE 0 END) * 1e2 / count(*)')} AS low_percent FROM obs_hourly GROUP BY cell_id")
def percent_of(spark: SparkSession, d: str) -> DataFrame:
    """Share of steps with low wind, of the steps that there are."""
    low = F.sum(F.when(c("ws") < 3.0, 1).otherwise(0)).cast("double")
    return obs_hourly(spark, d).groupBy("cell_id").agg(rounded(T.percent_of(low, F.count(F.lit(1)).cast("double"))).alias("low_percent"))

"""Queries of scans, sinks, catalogues and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol import jobs
from galesol.functions import turbines, wind as W
from galesol.operators import grid as G, temporal
from galesol.plans.columns import KEY, power_sql
from galesol.plans.registry import query, r
from galesol.sources import catalog, curves, grid as S, intake, layout
from galesol.sources.fixtures import dim_mask, obs_daily, obs_hourly, rounded

c = F.col


@query(f"SELECT cell_id, day, {r('ws')} AS ws FROM obs_daily WHERE day BETWEEN DATE '1996-02-01' AND DATE '1996-03-31'")
def scan_grid(spark: SparkSession, d: str) -> DataFrame:
    """The period's rows of a table partitioned by day; partitions outside it aren't read."""
    path = catalog.shared_path(spark, "grid")
    catalog.write_indicator(obs_daily(spark, d).withColumn("month", F.trunc("day", "month")), path, "month")
    months = S.scan_grid(spark, path, None, "1996-02-01", "1996-03-31", "month")
    return months.select("cell_id", "day", rounded(c("ws")).alias("ws"))


@query(f"SELECT cell_id, day, {r('tm')} AS tm FROM obs_daily WHERE year(day) IN (1996, 1998)")
def concat_time(spark: SparkSession, d: str) -> DataFrame:
    days = obs_daily(spark, d)
    parts = [days.where(F.year("day") == y).select("cell_id", "day", "tm") for y in (1996, 1998)]
    return S.concat_time(parts).select("cell_id", "day", rounded(c("tm")).alias("tm"))


_CURVE_ROWS = ", ".join(f"('{k}', {first + turbines.STEP * i!r}::DOUBLE, {p}::DOUBLE)" for k, (first, power) in turbines.CURVES.items() for i, p in enumerate(power))
_SPEC_ROWS = ", ".join(f"('{t.iec_class}', '{t.model}', {t.rated_power}, {t.cut_in!r}::DOUBLE, {t.cut_out!r}::DOUBLE)" for t in turbines.TURBINES)


@query(f"SELECT iec_class, wind_speed, power, count(event_id) AS n_obs FROM (VALUES {_CURVE_ROWS}) p(iec_class, wind_speed, power) LEFT JOIN obs_hourly ON floor(ws / 5e-1) = wind_speed / 5e-1 GROUP BY 1, 2, 3")
def scan_power_curve(spark: SparkSession, d: str) -> DataFrame:
    """Every knot of the curves with the observations in the half metre above it."""
    seen = obs_hourly(spark, d).groupBy(F.floor(c("ws") / turbines.STEP).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    curve = turbines.dim_power_curve(spark).withColumn("k", (c("wind_speed") / turbines.STEP).cast("long"))
    return curve.join(seen, "k", "left").select("iec_class", "wind_speed", "power", F.coalesce("n", F.lit(0)).cast("long").alias("n_obs"))


#: A curve as it is, and one whose knots are spaced unevenly.
_USER = {"even": ("I", list(range(len(turbines.CURVES["I"][1])))), "uneven": ("S", [i for i in range(len(turbines.CURVES["S"][1])) if i % 3 or i == 0])}
_USER_KNOTS = [(name, turbines.CURVES[k][0] + turbines.STEP * i, float(turbines.CURVES[k][1][i])) for name, (k, used) in _USER.items() for i in used]
_USER_SPECS = [(name, t.rated_power, t.cut_in, t.rated_speed, t.cut_out) for name, (k, _) in _USER.items() for t in [turbines.turbine(k)]]
_KNOT_ROWS = ", ".join(f"('{n}', {x!r}::DOUBLE, {y!r}::DOUBLE)" for n, x, y in _USER_KNOTS)
_USER_ROWS = ", ".join(f"('{n}', {p}::DOUBLE, {a!r}::DOUBLE, {b!r}::DOUBLE, {z!r}::DOUBLE)" for n, p, a, b, z in _USER_SPECS)


def _end_sql(h: str, d: str, fh: str, fd: str) -> str:
    m = f"(((2 * {h} + {fh}) * {d} - {h} * {fd}) / ({h} + {fh}))"
    return f"CASE WHEN {m} * {d} <= 0 THEN 0e0 WHEN {d} * {fd} <= 0 AND abs({m}) > abs(3 * {d}) THEN 3 * {d} ELSE {m} END"


@query(
    f"""SELECT event_id, o.curve, {r('CASE WHEN ws < cut_in THEN 0e0 WHEN ws <= rated_speed THEN least(y + (ws - x) * (m + (ws - x) * (c + (ws - x) * b)), rated) WHEN ws <= cut_out THEN rated ELSE 0e0 END')} AS power
  FROM (SELECT *, CASE event_id % 2 WHEN 0 THEN 'even' ELSE 'uneven' END AS curve FROM obs_hourly) o JOIN (VALUES {_USER_ROWS}) s(curve, rated, cut_in, rated_speed, cut_out) ON s.curve = o.curve
  JOIN pieces p ON p.curve = o.curve AND (ws >= x OR n = 1) AND (ws < x1 OR x1 = x_last)""",
    s1=f"SELECT *, lead(x) OVER w AS x1, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS d, row_number() OVER w AS n, max(x) OVER (PARTITION BY curve) AS x_last FROM (VALUES {_KNOT_ROWS}) k(curve, x, y) WINDOW w AS (PARTITION BY curve ORDER BY x)",
    s2="SELECT *, lag(h) OVER w AS hp, lag(d) OVER w AS dp, lag(h, 2) OVER w AS hq, lag(d, 2) OVER w AS dq, lead(h) OVER w AS hn, lead(d) OVER w AS dn FROM s1 WINDOW w AS (PARTITION BY curve ORDER BY x)",
    s3=f"SELECT *, CASE WHEN dp IS NULL THEN {_end_sql('h', 'd', 'hn', 'dn')} WHEN d IS NULL THEN {_end_sql('hp', 'dp', 'hq', 'dq')} WHEN dp * d <= 0 THEN 0e0 ELSE (3 * h + 3 * hp) / ((2 * h + hp) / dp + (h + 2 * hp) / d) END AS m FROM s2",
    s4="SELECT *, lead(m) OVER (PARTITION BY curve ORDER BY x) AS m1 FROM s3",
    pieces="SELECT curve, n, x, x1, x_last, y, m, (3 * d - 2 * m - m1) / h AS c, (m - 2 * d + m1) / (h * h) AS b FROM s4 WHERE x1 IS NOT NULL",
)
def user_power_curve(spark: SparkSession, d: str) -> DataFrame:
    """Power by curves read from files, one with uneven knots."""
    path = catalog.shared_path(spark, "curves")
    for name in _USER:
        text = "\n".join([f"{name},", "wind_speed,power", *[f"{x},{y}" for n, x, y in reversed(_USER_KNOTS) if n == name]])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
    pieces = curves.cubic_pieces(curves.read_power_curves(spark, path))
    specs = spark.createDataFrame(_USER_SPECS, "curve string, rated_power int, cut_in double, rated_speed double, cut_out double")
    hours = obs_hourly(spark, d).withColumn("curve", F.when(c("event_id") % 2 == 0, "even").otherwise("uneven"))
    return curves.power_by_curve(hours, pieces, specs).select("event_id", "curve", rounded(c("power")).alias("power"))


@query("SELECT event_id, cell_id, ws FROM obs_hourly WHERE CAST(time AS DATE) IN (SELECT CAST(time AS DATE) FROM obs_hourly GROUP BY 1 HAVING count(DISTINCT hour(time)) = 24)")
def intake_complete_days(spark: SparkSession, d: str) -> DataFrame:
    """Rows of complete days, from files that came in two deliveries."""
    source, out = catalog.shared_path(spark, "source"), catalog.shared_path(spark, "complete")
    desk = intake.Intake(spark, source, catalog.shared_path(spark, "intake"))
    hours = obs_hourly(spark, d)
    for part in (c("event_id") % 3 < 2, c("event_id") % 3 == 2):
        hours.where(part).write.mode("append").parquet(source)
        desk.take()
    desk.release(lambda rows: catalog.write_indicator(rows, out, "day"))
    done = spark.read.schema("event_id long, cell_id int, ws double, day date").parquet(out) if desk.released().take(1) else hours.where("false")
    return done.select("event_id", "cell_id", "ws")


@query("SELECT lat_idx, lon_idx, lat, lon, mask FROM dim_mask")
def scan_mask(spark: SparkSession, d: str) -> DataFrame:
    return dim_mask(spark, d).select("lat_idx", "lon_idx", "lat", "lon", "mask")


_CLIM = "SELECT cell_id, month(day) AS month, day(day) AS dom, avg(ws) AS ws FROM obs_daily WHERE NOT (month(day) = 2 AND day(day) = 29) GROUP BY 1, 2, 3"


@query(f"SELECT cell_id, month::INTEGER AS month, dom::INTEGER AS dom, {r('ws * power(1e1, 1.43e-1)')} AS ws FROM clim", clim=_CLIM)
def scan_climatology(spark: SparkSession, d: str) -> DataFrame:
    clim = temporal.daily_climatology(obs_daily(spark, d), "ws", ["cell_id"])
    return S.scan_climatology(clim).select("cell_id", "month", "dom", rounded(c("ws")).alias("ws"))


@query(f"SELECT iec_class, model, rated_power, sum(CASE WHEN ws >= cut_in AND ws <= cut_out THEN 1 ELSE 0 END)::BIGINT AS n_running FROM obs_hourly CROSS JOIN (VALUES {_SPEC_ROWS}) t(iec_class, model, rated_power, cut_in, cut_out) GROUP BY 1, 2, 3")
def dim_turbine(spark: SparkSession, d: str) -> DataFrame:
    """Each turbine with the observations at which it runs."""
    rows = obs_hourly(spark, d).select("ws").crossJoin(F.broadcast(turbines.dim_turbine(spark)))  # six rows
    runs = F.sum(F.when((c("ws") >= c("cut_in")) & (c("ws") <= c("cut_out")), 1).otherwise(0)).cast("long")
    return rows.groupBy("iec_class", "model", "rated_power").agg(runs.alias("n_running"))


@query(f"SELECT cell_id, CAST(time AS DATE) AS date, {r('avg(ws)')} AS ws FROM obs_hourly GROUP BY 1, 2")
def write_indicator(spark: SparkSession, d: str) -> DataFrame:
    """Daily means, written, and a day written again: the rerun replaces its own days only."""
    days = obs_hourly(spark, d).groupBy("cell_id", c("time").cast("date").alias("date")).agg(rounded(F.avg("ws")).alias("ws"))
    path = catalog.shared_path(spark, "indicator")
    catalog.write_indicator(days, path)
    catalog.write_indicator(days.where(F.dayofmonth("date") == 2), path)
    return spark.read.schema(days.schema).parquet(path)


@query("SELECT 'hourly' AS model, min(cell_id) AS first_cell, 'created from 2 inputs' AS message, 'yes' AS mask, count(*) AS n FROM obs_hourly")
def run_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of one run: identity keys, joined histories, message and stamp."""
    obs = obs_hourly(spark, d)
    facts = obs.agg(F.min("cell_id").cast("string").alias("first"), F.count(F.lit(1)).cast("string").alias("n"))
    inputs = facts.select(F.explode(F.array(F.struct(F.lit("u").alias("source"), c("n").alias("history")), F.struct(F.lit("v").alias("source"), c("first").alias("history")))).alias("i")).select("i.*")
    meta = catalog.run_metadata(inputs, {"model": F.lit("hourly")}, "created from 2 inputs", mask=True)
    lines = F.split("history", "\n")
    return meta.select(c("identity")["model"].alias("model"), lines[1].cast("int").alias("first_cell"), lines[2].alias("message"), "mask", lines[0].cast("long").alias("n"))


@query("SELECT time, lat_idx, lon_idx, lat, lon, u, v FROM obs_hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-16' AND hour(time) IN (0, 6, 12, 18) AND lat BETWEEN 35 AND 50 AND lon BETWEEN 0 AND 30")
def request_subset(spark: SparkSession, d: str) -> DataFrame:
    return S.request_subset(obs_hourly(spark, d), ["u", "v"], "2024-01-05", "2024-01-15", [0, 6, 12, 18], (50.0, 0.0, 35.0, 30.0))


@query("SELECT CAST(time AS DATE) AS date, min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon, count(*) AS n_rows FROM obs_hourly GROUP BY 1")
def output_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Bounding boxes read back from a written, date-partitioned output."""
    path = catalog.shared_path(spark, "catalog")
    catalog.write_indicator(obs_hourly(spark, d).select("lat", "lon", "ws", c("time").cast("date").alias("date")), path)
    return catalog.output_catalog(spark.read.parquet(path))


@query()
def latest_input(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest_input(spark, f"{d}/events.parquet")


@query("SELECT min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon, min(time) AS first_time, max(time) AS last_time FROM obs_hourly")
def spatial_extent(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@query("SELECT cell_id, min(time) AS first_time, strftime(min(time), '%Y_%m_%d_T%H_%M_wind_speed') AS name FROM obs_hourly GROUP BY cell_id")
def first_timestamp(spark: SparkSession, d: str) -> DataFrame:
    first = obs_hourly(spark, d).groupBy("cell_id").agg(F.min("time").alias("first_time"))
    return first.withColumn("name", catalog.file_name(c("first_time"), "wind_speed"))


@query("SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS n_repeated, sum(nu)::BIGINT AS null_u, sum(nw)::BIGINT AS null_ws FROM (SELECT count(*) AS n, count(*) - count(u) AS nu, count(*) - count(ws) AS nw FROM obs_hourly GROUP BY time, lat_idx, lon_idx)")
def validate_grid(spark: SparkSession, d: str) -> DataFrame:
    obs = G.nan_to_null(obs_hourly(spark, d))
    S.require_columns(obs, {"time": "timestamp", "lat_idx": "int", "lon_idx": "int", "u": "double", "ws": "double"})
    return S.validate_grid(obs, ["time", "lat_idx", "lon_idx"], ["u", "ws"])


@query(f"SELECT event_id, {r('sqrt(u * u + v * v)')} AS ws, {r('t2m_k')} AS t2m FROM obs_hourly")
def build_dataset(spark: SparkSession, d: str) -> DataFrame:
    obs = obs_hourly(spark, d)
    parts = {"ws": obs.select("event_id", rounded(W.wind_speed(c("u"), c("v"))).alias("ws")), "t2m": obs.select("event_id", rounded(c("t2m_k")).alias("t2m"))}
    return S.build_dataset(parts, ["event_id"], {"ws": {"units": "m/s"}, "t2m": {"units": "K"}})


@query(f"SELECT event_id, {r('sqrt(u * u + v * v)')} AS ws FROM obs_hourly")
def align_uv(spark: SparkSession, d: str) -> DataFrame:
    """u and v stored apart, paired on their key."""
    obs = obs_hourly(spark, d)
    return obs.select("event_id", "u").join(obs.select("event_id", "v"), "event_id").select("event_id", rounded(W.wind_speed(c("u"), c("v"))).alias("ws"))


@query(f"SELECT cell_id, day, {r('tm')} AS tm, {r('tx')} AS tx, {r('tn')} AS tn FROM obs_daily")
def align_three(spark: SparkSession, d: str) -> DataFrame:
    """Three variables in tall form aligned by one conditional aggregation, without joins."""
    tall = obs_daily(spark, d).select("cell_id", "day", F.expr("stack(3, 'tm', tm, 'tx', tx, 'tn', tn) as (name, value)"))
    pick = lambda n: rounded(F.max(F.when(c("name") == n, c("value")))).alias(n)
    return tall.groupBy("cell_id", "day").agg(pick("tm"), pick("tx"), pick("tn"))


_MASKED = """SELECT o.event_id, o.cell_id, CASE WHEN m.mask > 5e-1 THEN o.ws END AS ws FROM obs_hourly o
  LEFT JOIN (SELECT a.idx AS lat_idx, b.idx AS lon_idx, m.mask FROM near_lat a CROSS JOIN near_lon b JOIN dim_mask m ON m.lat_idx = a.other AND m.lon_idx = b.other) m
  ON o.lat_idx = m.lat_idx AND o.lon_idx = m.lon_idx"""


def _near(name: str) -> str:
    """SQL axis map from the grid to the mask moved by 0.4 degree; ties to the smaller coordinate, nothing outside its reach."""
    return f"""SELECT a.idx, arg_min(b.idx, abs(b.x - a.x) * 1e6 + b.x / 1e3) AS other FROM (SELECT DISTINCT {name}_idx AS idx, {name} AS x FROM obs_hourly) a
  CROSS JOIN (SELECT DISTINCT {name}_idx AS idx, {name} + 4e-1 AS x FROM dim_mask) b
  WHERE a.x BETWEEN (SELECT min({name} + 4e-1) FROM dim_mask) AND (SELECT max({name} + 4e-1) FROM dim_mask) GROUP BY a.idx"""


@query(_MASKED, near_lat=_near("lat"), near_lon=_near("lon"))
def onshore_mask(spark: SparkSession, d: str) -> DataFrame:
    """A mask whose grid lies 0.4 degree off the data's."""
    moved = dim_mask(spark, d).withColumn("lat", c("lat") + 0.4).withColumn("lon", c("lon") + 0.4)
    return G.onshore_mask(obs_hourly(spark, d), moved, ["ws"]).select(*KEY, "ws")


_LATS = "SELECT range AS idx, 3.5e1 + range::DOUBLE AS x FROM range(0, 11)"
_LONS = "SELECT range AS idx, 4e0 * range AS x FROM range(0, 8)"


@query(
    """SELECT o.event_id, a.idx::INTEGER AS lat_idx, b.idx::INTEGER AS lon_idx, a.x AS lat, b.x AS lon, o.ws FROM obs_hourly o
  JOIN (SELECT t.idx, any_value(t.x) AS x, arg_min(s.idx, abs(s.x - t.x) * 1e6 + s.x / 1e3) AS o FROM lats t CROSS JOIN (SELECT DISTINCT lat_idx AS idx, lat AS x FROM obs_hourly) s GROUP BY t.idx) a ON a.o = o.lat_idx
  JOIN (SELECT t.idx, any_value(t.x) AS x, arg_min(s.idx, abs(s.x - t.x) * 1e6 + s.x / 1e3) AS o FROM lons t CROSS JOIN (SELECT DISTINCT lon_idx AS idx, lon AS x FROM obs_hourly) s GROUP BY t.idx) b ON b.o = o.lon_idx""",
    lats=_LATS,
    lons=_LONS,
)
def regrid_nn(spark: SparkSession, d: str) -> DataFrame:
    """Observations on a 1 x 4 degree grid, each target cell taking its nearest source cell."""
    lat = spark.range(11).select(c("id").cast("int").alias("idx"), (35.0 + c("id").cast("double")).alias("x"))
    lon = spark.range(8).select(c("id").cast("int").alias("idx"), (4.0 * c("id")).alias("x"))
    obs = obs_hourly(spark, d).select("event_id", "lat_idx", "lon_idx", "lat", "lon", "ws")
    return G.regrid_nearest(obs, lat, lon, ["event_id", "ws"]).select("event_id", "lat_idx", "lon_idx", "lat", "lon", "ws")


@query(f"SELECT o.cell_id, o.day, {r('o.ws')} AS ws, {r('c.ws')} AS base FROM obs_daily o JOIN clim c ON o.cell_id = c.cell_id AND month(o.day) = c.month AND day(o.day) = c.dom", clim=_CLIM)
def climatology_join(spark: SparkSession, d: str) -> DataFrame:
    days = obs_daily(spark, d)
    clim = temporal.daily_climatology(days, "ws", ["cell_id"]).withColumnRenamed("ws", "base")
    return temporal.climatology_join(days, clim, ["cell_id"]).select("cell_id", "day", rounded(c("ws")).alias("ws"), rounded(c("base")).alias("base"))


@query(f"SELECT event_id, iec_class, model FROM obs_hourly JOIN (VALUES {_SPEC_ROWS}) t(iec_class, model, rated_power, cut_in, cut_out) ON iec_class = CASE event_id % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'II' ELSE 'S' END")
def turbine_join(spark: SparkSession, d: str) -> DataFrame:
    """Sites of three classes with their turbine."""
    cls = F.when(c("event_id") % 3 == 0, "I").when(c("event_id") % 3 == 1, "II").otherwise("S")
    return obs_hourly(spark, d).withColumn("iec_class", cls).join(F.broadcast(turbines.dim_turbine(spark)), "iec_class").select("event_id", "iec_class", "model")  # six rows


_DENSE = "SELECT lat_idx, lon_idx, row_number() OVER (ORDER BY lat_idx, lon_idx) - 1 AS cell FROM dim_mask WHERE mask > 5e-1"


@query("SELECT event_id, cell, ws FROM obs_hourly JOIN dense USING (lat_idx, lon_idx)", dense=_DENSE)
def mask_compact(spark: SparkSession, d: str) -> DataFrame:
    return G.mask_compact(obs_hourly(spark, d), dim_mask(spark, d)).select("event_id", "cell", "ws")


@query(f"SELECT m.lat_idx, m.lon_idx, {r('avg(o.ws)')} AS ws FROM dim_mask m LEFT JOIN dense USING (lat_idx, lon_idx) LEFT JOIN obs_hourly o ON o.lat_idx = m.lat_idx AND o.lon_idx = m.lon_idx AND dense.cell IS NOT NULL GROUP BY 1, 2", dense=_DENSE)
def mask_scatter(spark: SparkSession, d: str) -> DataFrame:
    mask = dim_mask(spark, d)
    means = G.mask_compact(obs_hourly(spark, d), mask).groupBy("cell").agg(rounded(F.avg("ws")).alias("ws"))
    return G.mask_scatter(means, mask).select("lat_idx", "lon_idx", "ws")


@query("SELECT lat_idx, lon_idx, cell FROM dense", dense=_DENSE)
def dense_cell_id(spark: SparkSession, d: str) -> DataFrame:
    return G.dense_cell_id(dim_mask(spark, d)).select("lat_idx", "lon_idx", "cell")


POINT_SQL = """SELECT * FROM obs_hourly WHERE lat_idx = (SELECT lat_idx FROM (SELECT DISTINCT lat_idx, lat FROM obs_hourly) ORDER BY abs(lat - 4.125e1), -lat LIMIT 1)
  AND lon_idx = (SELECT lon_idx FROM (SELECT DISTINCT lon_idx, lon FROM obs_hourly) ORDER BY abs(lon - 4.5e0), -lon LIMIT 1)"""


@query("SELECT event_id, lat, lon, ws FROM pt", pt=POINT_SQL)
def select_point(spark: SparkSession, d: str) -> DataFrame:
    return G.select_point(obs_hourly(spark, d), 41.25, 4.5).select("event_id", "lat", "lon", "ws")


_IN_PERIOD = "SELECT * REPLACE (sqrt(u * u + v * v) AS ws) FROM obs_hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-13'"


def _period(spark: SparkSession, d: str, name: str) -> DataFrame:
    """What a run over a week, masked by a grid that lies off the data's, has written; run twice."""
    source, out = catalog.shared_path(spark, "grid"), catalog.shared_path(spark, "period")
    catalog.write_indicator(obs_hourly(spark, d).withColumn("date", c("time").cast("date")), source)
    moved = dim_mask(spark, d).withColumn("lat", c("lat") + 0.4).withColumn("lon", c("lon") + 0.4)
    for _ in range(2):
        jobs.run_period(spark, source, name, "2024-01-05", "2024-01-12", out, moved)
    return spark.read.parquet(f"{out}/{jobs.INDICATORS[name].short}")


_LAND = "SELECT a.idx AS lat_idx, b.idx AS lon_idx FROM near_lat a CROSS JOIN near_lon b JOIN dim_mask m ON m.lat_idx = a.other AND m.lon_idx = b.other WHERE mask > 5e-1"


@query(
    f"SELECT time, p.lat_idx, p.lon_idx, {r('CASE WHEN l.lat_idx IS NOT NULL THEN power / rated END')} AS cf FROM p LEFT JOIN land l ON l.lat_idx = p.lat_idx AND l.lon_idx = p.lon_idx",
    near_lat=_near("lat").replace("FROM obs_hourly", "FROM (SELECT * FROM obs_hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-13')"),
    near_lon=_near("lon").replace("FROM obs_hourly", "FROM (SELECT * FROM obs_hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-13')"),
    land=_LAND,
    week_=_IN_PERIOD,
    p=power_sql("week_", ["I"]),
)
def period_capacity_factor(spark: SparkSession, d: str) -> DataFrame:
    return _period(spark, d, "capacity_factor_i").select("time", *G.CELL, rounded(c("cf_I")).alias("cf"))


@query(
    "SELECT w.lat_idx, w.lon_idx, count(l.lat_idx) AS n_valid, CASE WHEN count(l.lat_idx) > 0 THEN sum(CASE WHEN ws < 3 AND l.lat_idx IS NOT NULL THEN 1 ELSE 0 END)::BIGINT END AS lwe FROM week_ w LEFT JOIN land l ON l.lat_idx = w.lat_idx AND l.lon_idx = w.lon_idx GROUP BY 1, 2",
    near_lat=_near("lat"),
    near_lon=_near("lon"),
    land=_LAND,
    week_=_IN_PERIOD,
)
def period_low_wind_events(spark: SparkSession, d: str) -> DataFrame:
    return _period(spark, d, "low_wind_events").select(*G.CELL, "n_valid", "lwe")


@query(f"SELECT o.cell_id, o.day, {r('o.tm')} AS tm, {r('o.ws - c.ws')} AS departure FROM obs_daily o JOIN clim c ON o.cell_id = c.cell_id AND month(o.day) = c.month AND day(o.day) = c.dom", clim=_CLIM)
def layout_joins(spark: SparkSession, d: str) -> DataFrame:
    """Two variables and a climatology, each laid out by cell, joined where they lie."""
    days = obs_daily(spark, d)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clim = temporal.daily_climatology(days, "ws", ["cell_id"]).withColumnRenamed("ws", "base")
    ws, tm = (layout.lay_out(days.select("cell_id", "day", v), n, ["cell_id"], ["day"]) for v in ("ws", "tm"))
    base = layout.lay_out(clim, n, ["cell_id"], ["month", "dom"])
    with layout.joined_by_cell(spark):
        both = temporal.climatology_join(ws.join(tm, ["cell_id", "day"]), base, ["cell_id"])
        out = both.select("cell_id", "day", rounded(c("tm")).alias("tm"), rounded(c("ws") - c("base")).alias("departure"))
        out._jdf.queryExecution().executedPlan()
        return out

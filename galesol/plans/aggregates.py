"""Queries of aggregations, histograms, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.functions import weather as T, wind as W
from galesol.functions.calendar import SCALES
from galesol.operators import climate_store, grid as G, histogram as H, selection, temporal as A
from galesol.plans.columns import CDD, HDD, power_sql
from galesol.plans.joins import _CLIM, POINT_SQL
from galesol.plans.registry import query, r
from galesol.sources.catalog import kept, shared_path
from galesol.sources.fixtures import dim_mask, obs_daily, obs_hourly, rounded

c = F.col

BIN_SQL = {
    "daily": "CAST({t} AS DATE)",
    "weekly": "CAST(date_trunc('week', CAST({t} AS DATE)) AS DATE) + 6",
    "monthly": "last_day(CAST({t} AS DATE))",
    "annual": "make_date(year({t}), 12, 31)",
    "seasonal": "CAST(date_trunc('quarter', CAST({t} AS DATE) + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)",
}


def _rescale(scale: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return A.rescale(obs_daily(spark, d), "ws", scale, ["cell_id"], "day").select("cell_id", "bin", rounded(c("ws")).alias("ws"))

    query(f"SELECT cell_id, {BIN_SQL[scale].format(t='day')} AS bin, {r('avg(ws)')} AS ws FROM obs_daily GROUP BY 1, 2", name=f"rescale_{scale}")(run)


for _scale in SCALES:
    _rescale(_scale)


@query(f"SELECT cell_id, CAST(time AS DATE) AS day, {r('avg(ws)')} AS mean, {r('max(ws)')} AS max, {r('min(ws)')} AS min FROM obs_hourly GROUP BY 1, 2")
def daily_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.daily_stats(obs_hourly(spark, d), "ws", ["cell_id"]).select("cell_id", "day", *[rounded(c(n)).alias(n) for n in ("mean", "max", "min")])


_DAYS = "SELECT cell_id, CAST(time AS DATE) AS day, avg(ws) AS mean FROM obs_hourly GROUP BY 1, 2"


def _events(name: str, source: str, column: str, sign: str, limit: float) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = obs_hourly(spark, d) if source == "obs_hourly" else A.daily_stats(obs_hourly(spark, d), "ws", ["cell_id"])
        return A.count_where(rows, c(column) > limit if sign == ">" else c(column) < limit, column, ["cell_id"])

    sql = f"SELECT cell_id, sum(CASE WHEN {column} {sign} {limit!r}::DOUBLE THEN 1 ELSE 0 END)::BIGINT AS n_hits, count({column}) AS n_valid FROM {source} GROUP BY cell_id"
    query(sql, name=name, **({"days": _DAYS} if source == "days" else {}))(run)


_events("high_wind_events", "obs_hourly", "ws", ">", 25.0)
_events("low_wind_events", "obs_hourly", "ws", "<", 3.0)
_events("calm_days", "days", "mean", "<", 2.0)
_events("windy_days", "days", "mean", ">", 10.8)


@query(f"SELECT cell_id, {r('quantile_cont(ws, 9e-1)')} AS percentile FROM obs_hourly GROUP BY cell_id")
def percentile(spark: SparkSession, d: str) -> DataFrame:
    return A.percentile(obs_hourly(spark, d), "ws", 90.0, ["cell_id"]).select("cell_id", rounded(c("percentile")).alias("percentile"))


@query(f"SELECT {r('quantile_cont(ws, 9e-1)')} AS percentile FROM obs_hourly")
def percentile_of_all(spark: SparkSession, d: str) -> DataFrame:
    """One group of all rows, exact."""
    return selection.exact_percentile(obs_hourly(spark, d), "ws", 90.0, []).select(rounded(c("percentile")).alias("percentile"))


@query(f"SELECT lat_idx, {r('quantile_cont(power / rated, 3.75e-1)')} AS percentile FROM p GROUP BY lat_idx", p=power_sql("obs_hourly", ["I"]))
def percentile_selected(spark: SparkSession, d: str) -> DataFrame:
    """Exact capacity factors of large groups, many values being equal."""
    rows = obs_hourly(spark, d).withColumn("cf", W.capacity_factor(c("ws"), "I"))
    return selection.exact_percentile(rows, "cf", 37.5, ["lat_idx"]).select("lat_idx", rounded(c("percentile")).alias("percentile"))


@query(f"SELECT cell_id, month(day)::INTEGER AS month, day(day)::INTEGER AS dom, {r('avg(ws)')} AS ws FROM obs_daily WHERE NOT (month(day) = 2 AND day(day) = 29) AND year(day) BETWEEN 1997 AND 2001 GROUP BY 1, 2, 3")
def climatology_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Five years of a climatology that years were added to."""
    days, path = obs_daily(spark, d), shared_path(spark, "climate")
    climate_store.add_years(days.where("year(day) < 2000"), path, "ws", ["cell_id"])
    out = climate_store.rolling(days.where("year(day) >= 2000"), path, "ws", ["cell_id"], 5)
    return out.select("cell_id", "month", "dom", rounded(c("ws")).alias("ws"))


@query(f"SELECT cell_id, CASE WHEN count(x) = count(*) THEN {r('avg(x)')} END AS mean FROM (SELECT cell_id, CASE WHEN cell_id % 4 = 0 AND ws < 1 THEN NULL ELSE ws END AS x FROM obs_hourly) GROUP BY cell_id")
def time_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = obs_hourly(spark, d).withColumn("x", F.when(~((c("cell_id") % 4 == 0) & (c("ws") < 1)), c("ws")))
    return A.time_mean(rows, "x", ["cell_id"]).select("cell_id", rounded(c("mean")).alias("mean"))


@query(f"SELECT cell_id, year(day)::INTEGER AS year, month(day)::INTEGER AS month, {r('avg(ws)')} AS ws FROM obs_daily GROUP BY 1, 2, 3")
def monthly_mean_by_year(spark: SparkSession, d: str) -> DataFrame:
    return obs_daily(spark, d).groupBy("cell_id", F.year("day").alias("year"), F.month("day").alias("month")).agg(rounded(F.avg("ws")).alias("ws"))


@query(f"SELECT cell_id, year(time)::INTEGER AS year, {r('sum(power / rated * 2.3e0)')} AS energy FROM p GROUP BY 1, 2", p=power_sql("obs_hourly", ["I"]))
def energy_total(spark: SparkSession, d: str) -> DataFrame:
    energy = W.energy_production(W.capacity_factor(c("ws"), "I"), 2300.0)
    return obs_hourly(spark, d).groupBy("cell_id", F.year("time").alias("year")).agg(rounded(F.sum(energy)).alias("energy"))


@query(f"SELECT cell_id, {r(f'sum({CDD})')} AS cdd, {r(f'sum({HDD})')} AS hdd FROM obs_daily GROUP BY cell_id")
def degree_days_accumulated(spark: SparkSession, d: str) -> DataFrame:
    t = (c("tm"), c("tx"), c("tn"))
    return obs_daily(spark, d).groupBy("cell_id").agg(rounded(F.sum(T.cooling_degree_days(*t))).alias("cdd"), rounded(F.sum(T.heating_degree_days(*t))).alias("hdd"))


@query(f"SELECT o.cell_id, last_day(o.day) AS bin, {r('avg(o.ws) - avg(c.ws)')} AS anomaly FROM obs_daily o JOIN clim c ON o.cell_id = c.cell_id AND month(o.day) = c.month AND day(o.day) = c.dom GROUP BY 1, 2", clim=_CLIM)
def wind_speed_anomalies(spark: SparkSession, d: str) -> DataFrame:
    days = obs_daily(spark, d)
    clim = A.daily_climatology(days, "ws", ["cell_id"]).withColumnRenamed("ws", "base")
    return A.anomalies(days, clim, "ws", "base", "monthly", ["cell_id"]).select("cell_id", "bin", rounded(c("anomaly")).alias("anomaly"))


_MONTHS = "SELECT cell_id, last_day(day) AS bin, avg(ws) AS ws FROM obs_daily GROUP BY 1, 2"


_DAY_NUMBER = "datediff('day', DATE '1970-01-01', bin)::DOUBLE"


@query(f"SELECT cell_id, {r(f'regr_slope(ws, {_DAY_NUMBER})')} AS slope, {r(f'regr_intercept(ws, {_DAY_NUMBER})', 4)} AS intercept FROM months GROUP BY cell_id", months=_MONTHS)
def trend(spark: SparkSession, d: str) -> DataFrame:
    months = A.rescale(obs_daily(spark, d), "ws", "monthly", ["cell_id"], "day")
    return A.trend(months, "ws", ["cell_id"]).select("cell_id", rounded(c("slope")).alias("slope"), rounded(c("intercept"), 4).alias("intercept"))


@query(f"SELECT cell_id, {r('min(ws)')} AS lo, (CAST(trunc(max(ws) / 5) AS INTEGER) + 1) * 5 AS hi FROM obs_hourly GROUP BY cell_id")
def value_range(spark: SparkSession, d: str) -> DataFrame:
    return obs_hourly(spark, d).groupBy("cell_id").agg(rounded(F.min("ws")).alias("lo"), (((F.max("ws") / 5).cast("int") + 1) * 5).alias("hi"))


_SMOOTH = """SELECT cell_id, month, dom, avg(ws) OVER (PARTITION BY cell_id ORDER BY n RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS ws, n FROM (
  SELECT *, dayofyear(make_date(2001, month, dom)) AS n FROM clim UNION ALL SELECT *, 0 AS n FROM clim WHERE month = 12 AND dom = 31 UNION ALL SELECT *, 366 AS n FROM clim WHERE month = 1 AND dom = 1)"""


@query(f"SELECT cell_id, month::INTEGER AS month, dom::INTEGER AS dom, {r('ws')} AS ws FROM smooth WHERE n BETWEEN 1 AND 365", clim=_CLIM.replace("month(day) AS month", "month(day)::INTEGER AS month").replace("day(day) AS dom", "day(day)::INTEGER AS dom"), smooth=_SMOOTH)
def climatology_smooth(spark: SparkSession, d: str) -> DataFrame:
    clim = A.daily_climatology(obs_daily(spark, d), "ws", ["cell_id"])
    return A.climatology_smooth(clim, "ws", ["cell_id"]).select("cell_id", "month", "dom", rounded(c("ws")).alias("ws"))


@query(f"SELECT cell_id, month::INTEGER AS month, dom::INTEGER AS dom, {r('ws')} AS ws FROM clim", clim=_CLIM)
def daily_climatology(spark: SparkSession, d: str) -> DataFrame:
    return A.daily_climatology(obs_daily(spark, d), "ws", ["cell_id"]).select("cell_id", "month", "dom", rounded(c("ws")).alias("ws"))


@query(f"SELECT cell_id, CAST(time AS DATE) AS bin, {r('avg(power / rated)')} AS cf FROM p GROUP BY 1, 2", p=power_sql("obs_hourly", ["II"]))
def daily_mean_cf(spark: SparkSession, d: str) -> DataFrame:
    rows = obs_hourly(spark, d).withColumn("cf", W.capacity_factor(c("ws"), "II"))
    return A.rescale(rows, "cf", "daily", ["cell_id"]).select("cell_id", "bin", rounded(c("cf")).alias("cf"))


def _hist_sql(x: str, key: str, bins: int) -> dict[str, str]:
    part = f"GROUP BY {key}" if key else ""
    k = f"{key}, " if key else ""
    on = f"USING ({key})" if key else "ON true"
    return {
        "edges": f"SELECT {k}min({x}) - CASE WHEN min({x}) = max({x}) THEN 5e-1 ELSE 0e0 END AS lo, max({x}) + CASE WHEN min({x}) = max({x}) THEN 5e-1 ELSE 0e0 END AS hi FROM src WHERE {x} IS NOT NULL {part}",
        "counts": f"SELECT {k}CAST(least(floor(({x} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM src JOIN edges {on} WHERE {x} IS NOT NULL GROUP BY ALL",
        "hist": f"SELECT {k}b.bin, lo + b.bin * ((hi - lo) / {bins}) AS lo, lo + (b.bin + 1) * ((hi - lo) / {bins}) AS hi, coalesce(n, 0)::BIGINT AS count FROM edges CROSS JOIN (SELECT range::INTEGER AS bin FROM range({bins})) b LEFT JOIN counts USING ({k}bin)",
    }


def _hist_out(h: DataFrame, keys: list[str]) -> DataFrame:
    return h.select(*keys, "bin", rounded(c("lo")).alias("lo"), rounded(c("hi")).alias("hi"), "count")


def _hist_query(key: str) -> str:
    k = f"{key}, " if key else ""
    return f"SELECT {k}bin, {r('lo')} AS lo, {r('hi')} AS hi, count FROM hist"


@query(_hist_query("cell_id"), src="SELECT * FROM obs_hourly", **_hist_sql("ws", "cell_id", 20))
def wind_speed_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _hist_out(H.histogram(obs_hourly(spark, d), "ws", ["cell_id"], 20), ["cell_id"])


@query(_hist_query(""), src=POINT_SQL, **_hist_sql("ws", "", 20))
def wind_speed_histogram_1d(spark: SparkSession, d: str) -> DataFrame:
    return _hist_out(H.histogram(G.select_point(obs_hourly(spark, d), 41.25, 4.5), "ws", [], 20), [])


@query(_hist_query("cell_id"), src=f"SELECT cell_id, power / rated AS cf FROM ({power_sql('obs_hourly', ['III'])})", **_hist_sql("cf", "cell_id", 10))
def capacity_factor_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = obs_hourly(spark, d).select("cell_id", W.capacity_factor(c("ws"), "III").alias("cf"))
    return _hist_out(H.histogram(rows, "cf", ["cell_id"], 10), ["cell_id"])


@query(_hist_query(""), pt=POINT_SQL, src=f"SELECT power / rated AS cf FROM ({power_sql('pt', ['III'])})", **_hist_sql("cf", "", 10))
def capacity_factor_histogram_1d(spark: SparkSession, d: str) -> DataFrame:
    rows = G.select_point(obs_hourly(spark, d), 41.25, 4.5).select(W.capacity_factor(c("ws"), "III").alias("cf"))
    return _hist_out(H.histogram(rows, "cf", [], 10), [])


_MONTH_ROWS = f"SELECT lat_idx, lon_idx, CAST(date_trunc('month', time) AS DATE) AS month, power / rated AS cf FROM ({power_sql('obs_hourly', ['I'])})"


@query(
    f"""SELECT m.lat_idx, m.lon_idx, k.month, b.bin, {r('b.bin / 3e1')} AS lo, {r('(b.bin + 1) / 3e1')} AS hi, CASE WHEN m.mask > 5e-1 THEN coalesce(n.n, 0)::BIGINT END AS count
  FROM dim_mask m CROSS JOIN (SELECT DISTINCT month FROM rows_) k CROSS JOIN (SELECT range::INTEGER AS bin FROM range(30)) b
  LEFT JOIN (SELECT lat_idx, lon_idx, month, CAST(least(floor((cf - 0e0) / 1e0 * 30), 29) AS INTEGER) AS bin, count(*) AS n FROM rows_ GROUP BY ALL) n
  ON n.lat_idx = m.lat_idx AND n.lon_idx = m.lon_idx AND n.month = k.month AND n.bin = b.bin""",
    rows_=_MONTH_ROWS,
)
def cf_histogram_monthly(spark: SparkSession, d: str) -> DataFrame:
    """Monthly counts per unmasked cell between fixed edges, on the full grid; masked cells are null."""
    rows = obs_hourly(spark, d).withColumn("cf", W.capacity_factor(c("ws"), "I")).withColumn("month", F.trunc(c("time").cast("date"), "month"))
    counts = kept(H.packed_counts(rows, "cf", [*G.CELL, "month"], 30), "counts")
    grid = dim_mask(spark, d).select(*G.CELL, (c("mask") > 0.5).alias("land")).crossJoin(F.broadcast(counts.select("month").distinct()))  # twelve rows a year
    out = grid.join(counts, [*G.CELL, "month"], "left").select(*G.CELL, "month", "land", F.posexplode(F.coalesce("counts", F.array_repeat(F.lit(0).cast("long"), 30))).alias("bin", "count"))
    return out.select(*G.CELL, "month", "bin", rounded(c("bin") / 30.0).alias("lo"), rounded((c("bin") + 1) / 30.0).alias("hi"), F.when(c("land"), c("count")).alias("count"))


@query(f"SELECT cell_id, bin, {r('count::DOUBLE / (sum(count) OVER (PARTITION BY cell_id) * (hi - lo))')} AS density FROM hist", src="SELECT * FROM obs_hourly", **_hist_sql("ws", "cell_id", 20))
def histogram_density(spark: SparkSession, d: str) -> DataFrame:
    h = H.density(H.histogram(obs_hourly(spark, d), "ws", ["cell_id"], 20), ["cell_id"])
    return h.select("cell_id", "bin", rounded(c("density")).alias("density"))


@query(f"SELECT cell_id, event_id, {r('moving')} AS moving FROM (SELECT *, avg(ws) OVER w AS moving, row_number() OVER (PARTITION BY cell_id ORDER BY time, event_id) AS n FROM obs_hourly WINDOW w AS (PARTITION BY cell_id ORDER BY time, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n >= 5")
def moving_average(spark: SparkSession, d: str) -> DataFrame:
    return A.moving_average(obs_hourly(spark, d), "ws", 5, ["cell_id"], ["time", "event_id"]).select("cell_id", "event_id", rounded(c("moving")).alias("moving"))


@query(f"SELECT cell_id, event_id, {r('sum(power / rated * 2.3e0) OVER (PARTITION BY cell_id ORDER BY time, event_id ROWS UNBOUNDED PRECEDING)')} AS cumulative FROM p", p=power_sql("obs_hourly", ["I"]))
def cumulative_energy(spark: SparkSession, d: str) -> DataFrame:
    rows = obs_hourly(spark, d).withColumn("e", W.energy_production(W.capacity_factor(c("ws"), "I"), 2300.0))
    return A.cumulative(rows, "e", ["cell_id"], ["time", "event_id"]).select("cell_id", "event_id", rounded(c("cumulative")).alias("cumulative"))


_DOM = ", ".join(f"max(CASE WHEN day(day) = {i} THEN {r('ws')} END) AS d{i:02d}" for i in range(1, 32))


@query(f"SELECT cell_id, year(day)::INTEGER AS year, month(day)::INTEGER AS month, {_DOM} FROM obs_daily GROUP BY 1, 2, 3")
def calendar_pivot(spark: SparkSession, d: str) -> DataFrame:
    days = obs_daily(spark, d).select("cell_id", "day", rounded(c("ws")).alias("ws"))
    return A.calendar_pivot(days, "ws", ["cell_id"])


@query(f"SELECT cell_id, bin, max(CASE WHEN iec_class = 'I' THEN {r('cf')} END) AS cf_i, max(CASE WHEN iec_class = 'S' THEN {r('cf')} END) AS cf_s FROM (SELECT cell_id, iec_class, CAST(time AS DATE) AS bin, avg(power / rated) AS cf FROM p WHERE iec_class = 'S' OR ws >= 1 GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(*) = 2", p=power_sql("obs_hourly", ["I", "S"]))
def stack_classes(spark: SparkSession, d: str) -> DataFrame:
    """Daily factors of two classes side by side; days that lack one go."""
    obs = obs_hourly(spark, d)
    side = lambda rows, k: A.rescale(rows.withColumn("cf", W.capacity_factor(c("ws"), k)), "cf", "daily", ["cell_id"]).select("cell_id", "bin", rounded(c("cf")).alias(f"cf_{k.lower()}"))
    return side(obs.where("ws >= 1"), "I").join(side(obs, "S"), ["cell_id", "bin"])

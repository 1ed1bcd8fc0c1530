"""Jobs of one period: inputs by date, mask, indicator, named output, metadata and catalogue in one call."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galesol.functions import weather as T, wind as W
from galesol.operators import grid as G, temporal
from galesol.sources import catalog, grid as S

c = F.col


class Indicator(NamedTuple):
    """short: part of the output's name. columns: what the input must have, all double. value: a column expression of them, or None.

    event: whether a cell's hours count, for indicators that are counts over the period."""

    short: str
    columns: tuple[str, ...]
    value: Callable[[bool], Column] | None = None
    event: Callable[[], Column] | None = None


def _speed() -> Column:
    return W.wind_speed(c("u"), c("v"))


_DAY = ("tm", "tx", "tn")
INDICATORS = {
    "wind_direction": Indicator("wd", ("u", "v"), lambda zero: W.wind_direction(c("u"), c("v"))),
    "wind_speed_anomalies": Indicator("ws_anom", ("u", "v")),
    **{f"capacity_factor_{k.lower()}": Indicator(f"cf_{k}", ("u", "v"), lambda zero, k=k: W.capacity_factor(_speed(), k, zero)) for k in ("I", "II", "III", "S")},
    "cdd": Indicator("cdd", _DAY, lambda zero: T.cooling_degree_days(*map(c, _DAY), null_as_zero=zero)),
    "hdd": Indicator("hdd", _DAY, lambda zero: T.heating_degree_days(*map(c, _DAY), null_as_zero=zero)),
    "high_wind_events": Indicator("hwe", ("u", "v"), event=lambda: _speed() > 25.0),
    "low_wind_events": Indicator("lwe", ("u", "v"), event=lambda: _speed() < 3.0),
    "pv_potential": Indicator("pv", ("t2m", "g", "ws10"), lambda zero: T.pv_potential(c("t2m"), c("g"), c("ws10"))),
}


def indicator_of(rows: DataFrame, name: str, mask: DataFrame | None = None, climatology: DataFrame | None = None, null_as_zero: bool = False) -> DataFrame:
    """The named indicator of grid rows (time, lat_idx, lon_idx, lat, lon and its columns).

    Values: a row for each row, with the column `short`. Events: a row for each cell (first time, n_valid, `short`). Masked cells are null,
    or 0 with null_as_zero, in both. Anomalies: a row for each cell and day, against climatology (lat_idx, lon_idx, month, dom, base)."""
    spec = INDICATORS[name]
    S.require_columns(rows, {"time": "timestamp", "lat_idx": "int", "lon_idx": "int", "lat": "double", "lon": "double", **dict.fromkeys(spec.columns, "double")})
    rows = G.nan_to_null(rows.select("time", *G.CELL, "lat", "lon", *spec.columns))
    if mask is not None:
        rows = G.onshore_mask(rows, mask, list(spec.columns))
    place = [*G.CELL, "lat", "lon"]
    if spec.event is not None:
        counts = temporal.count_where(rows.withColumn("__v", _speed()), spec.event(), "__v", place, extra=[F.min("time").alias("time")], null_as_zero=null_as_zero)
        return counts.withColumnRenamed("n_hits", spec.short).select("time", *place, "n_valid", spec.short)
    if spec.value is not None:
        return rows.select("time", *place, spec.value(null_as_zero).alias(spec.short))
    if climatology is None:
        raise ValueError(f"{name} needs a climatology")
    days = rows.groupBy(*place, c("time").cast("date").alias("day")).agg(F.avg(_speed()).alias("ws"))
    found = temporal.climatology_join(days, climatology.select(*G.CELL, "month", "dom", "base"), G.CELL)
    value = c("ws") - c("base")
    return found.select(c("day").cast("timestamp").alias("time"), *place, (F.coalesce(value, F.lit(0.0)) if null_as_zero else value).alias(spec.short))


def run_period(spark: SparkSession, source: str, name: str, start: str, end: str, out: str, mask: DataFrame | None = None, climatology: DataFrame | None = None, null_as_zero: bool = False, message: str = "") -> DataFrame:
    """Run an indicator over the dates start to end (both included) of a grid table partitioned by `date`; returns the run's catalogue row.

    Output goes to out/<short>, by date (counts under the period's first date), and replaces those dates only; the catalogue, out/catalog,
    holds a row a run (name, dates, rows, box, mask, history), and a run of the same name replaces its row. A period without rows writes nothing
    and gives no row."""
    spec = INDICATORS[name]
    rows = S.scan_grid(spark, source, None, start, end)
    result = indicator_of(rows, name, mask, climatology, null_as_zero)
    date = F.lit(start).cast("date") if spec.event is not None else c("time").cast("date")
    catalog.write_indicator(result.withColumn("date", date), f"{out}/{spec.short}")
    schema = result.withColumn("date", date).schema
    written = S.scan_grid(spark, f"{out}/{spec.short}", schema, start, end)
    box = [f(n).alias(f"{f.__name__}_{n}") for n in ("lat", "lon") for f in (F.min, F.max)]
    facts = written.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("*").alias("n_rows"), *box).where("n_rows > 0")
    history = F.concat_ws("\n", F.lit(f"{source} {start} to {end}"), F.lit(message or f"{name} computed"))
    row = facts.select(catalog.file_name(c("first_time"), spec.short).alias("name"), F.lit(spec.short).alias("short"), F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"), "*", F.lit("no" if mask is None else "yes").alias("mask"), history.alias("history"))
    row = catalog.kept(row, "run")
    row.withColumn("run", c("name")).write.partitionBy("run").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{out}/catalog")
    return row

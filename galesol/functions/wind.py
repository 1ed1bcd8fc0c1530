"""Wind indicators as column expressions. A null input gives null, unless null_as_zero asks for 0."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from galesol.functions.turbines import STEP, pieces, turbine


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Degrees that the wind blows from; 180 when calm."""
    turned = F.degrees(F.atan2(-u, -v)) + 360.0
    return F.when((u == 0) & (v == 0), F.lit(180.0)).otherwise(F.pmod(turned, F.lit(360.0)))


def wind_power_density(ws: Column, air_density: Column | float = 1.225) -> Column:
    rho = air_density if isinstance(air_density, Column) else F.lit(air_density)
    return 0.5 * rho * ws * ws * ws


def wind_speed_at_height(u10: Column, v10: Column, hub_height: float, alpha: float = 0.143) -> Column:
    """Power-law speed at hub height; alpha is 0.11 offshore."""
    return wind_speed(u10, v10) * F.lit((hub_height / 10.0) ** alpha)


def _zeroed(ws: Column, value: Column, null_as_zero: bool) -> Column:
    return F.coalesce(value, F.lit(0.0)) if null_as_zero else F.when(ws.isNotNull(), value)


def power_output(ws: Column, iec_class: str, null_as_zero: bool = False) -> Column:
    """Power in kW. Knots are evenly spaced, so a literal array indexed by speed holds each cubic: no join."""
    t, cubic = turbine(iec_class), pieces(iec_class)
    k = F.least(F.greatest(F.floor((ws - cubic[0].x) / STEP), F.lit(0)), F.lit(len(cubic) - 1)).cast("int")
    # One parsed array a coefficient: a call for every literal would take longer than the rows of a day.
    at = lambda name: F.get(F.expr(f"array({', '.join(f'{float(getattr(p, name))!r}D' for p in cubic)})"), k)
    d = ws - at("x")
    curve = F.least(at("y") + d * (at("m") + d * (at("c") + d * at("b"))), F.lit(float(t.rated_power)))
    value = F.when(ws < t.cut_in, F.lit(0.0)).when(ws <= t.rated_speed, curve).when(ws <= t.cut_out, F.lit(float(t.rated_power))).otherwise(F.lit(0.0))
    return _zeroed(ws, value, null_as_zero)


def capacity_factor(ws: Column, iec_class: str, null_as_zero: bool = False) -> Column:
    return power_output(ws, iec_class, null_as_zero) / F.lit(float(turbine(iec_class).rated_power))


def weibull_power(ws: Column, rated_power: Column, cut_in: Column, rated_speed: Column, cut_out: Column, alfa: Column, k: Column) -> Column:
    """Power by a Weibull-shaped curve between cut-in and rated speed."""
    curve = rated_power * (1.0 - F.exp(-F.pow(ws * alfa, k)))
    return F.when(ws.isNotNull(), F.when(ws < cut_in, F.lit(0.0)).when(ws <= rated_speed, curve).when(ws <= cut_out, rated_power).otherwise(F.lit(0.0)))


def energy_production(cf: Column, rated_kw: float, turbines: int = 1) -> Column:
    """MWh of each hourly step."""
    return cf * F.lit(rated_kw / 1000.0) * F.lit(float(turbines))

"""Temperature, radiation, degree-day and photovoltaic expressions, and the sun's height."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

ZERO_C = 273.15


def convert_temperature(t: Column, unit: str = "C") -> Column:
    """To `unit` from the other of C and K."""
    return t - ZERO_C if unit == "C" else t + ZERO_C


def temperature_unit(low: Column, high: Column) -> Column:
    """K or C from the range of the values, for columns without unit metadata."""
    return F.when(low > 100.0, F.lit("K")).when(high < 100.0, F.lit("C"))


def convert_radiation(g: Column, unit: Column) -> Column:
    """Hourly J/m2 to W/m2; other units stay."""
    return F.when(unit == "J m**-2", g / 3600.0).otherwise(g)


def _known(value: Column, null_as_zero: bool, *needed: Column) -> Column:
    known = F.lit(True)
    for x in needed:
        known = known & x.isNotNull()
    return F.coalesce(F.when(known, value), F.lit(0.0)) if null_as_zero else F.when(known, value)


def cooling_degree_days(tm: Column, tx: Column, tn: Column, base: float = 22.0, null_as_zero: bool = False) -> Column:
    """Terms add up: they overlap only where tm lies outside [tn, tx]."""
    b, zero = F.lit(base), F.lit(0.0)
    quarter = F.when((tm <= b) & (b < tx), (tx - b) / 4.0).otherwise(zero)
    half = F.when((tn <= b) & (b < tm), (tx - b) / 2.0 - (b - tn) / 4.0).otherwise(zero)
    full = F.when(b < tn, tm - b).otherwise(zero)
    return _known(quarter + half + full, null_as_zero, tm, tx, tn)


def heating_degree_days(tm: Column, tx: Column, tn: Column, base: float = 15.5, null_as_zero: bool = False) -> Column:
    b, zero = F.lit(base), F.lit(0.0)
    full = F.when(b >= tx, b - tm).otherwise(zero)
    half = F.when((tm <= b) & (b < tx), (b - tn) / 2.0 - (tx - b) / 4.0).otherwise(zero)
    quarter = F.when((tn <= b) & (b < tm), (b - tn) / 4.0).otherwise(zero)
    return _known(full + half + quarter, null_as_zero, tm, tx, tn)


def pv_potential(t_c: Column, g: Column, ws: Column) -> Column:
    """Photovoltaic potential from temperature (C), radiation (W/m2) and wind (m/s)."""
    return 1.1035e-3 * g + 1.4e-7 * g * g - 4.715e-6 * g * t_c + 7.64e-6 * g * ws


def cosine_sza(time: Column, lat: Column, lon: Column) -> Column:
    """Cosine of the solar zenith angle, null while the sun is down."""
    day = F.dayofyear(time).cast("double")
    turn = day * (2 * math.pi / 365.0)
    tilt = F.radians(23.45 * F.sin((day - 81.0) * (2 * math.pi / 365.0)))
    equation = 9.87 * F.sin(2.0 * turn) - 7.53 * F.cos(turn) - 1.5 * F.sin(turn)
    minutes = F.hour(time) * 60.0 + F.minute(time) + 4.0 * lon + equation
    angle = F.radians(15.0 * (minutes / 60.0 - 12.0))
    cos = F.sin(F.radians(lat)) * F.sin(tilt) + F.cos(F.radians(lat)) * F.cos(tilt) * F.cos(angle)
    return F.when(cos > 0, F.least(cos, F.lit(1.0)))


def percent_of(value: Column, whole: Column) -> Column:
    return F.try_divide(value * 100.0, whole)

"""Turbine specifications, manufacturers' power curves and their monotone cubic pieces."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Turbine(NamedTuple):
    iec_class: str
    model: str
    rotor_diameter: int
    rated_power: int
    hub_height: float
    cut_in: float
    rated_speed: float
    cut_out: float


#: Specifications (m, kW, m, m/s).
TURBINES = (
    Turbine("I", "Enercon E70", 71, 2300, 85.0, 2.0, 15.5, 25.0),
    Turbine("I_II", "Gamesa G80", 80, 2000, 80.0, 3.5, 15.0, 25.0),
    Turbine("II", "Gamesa G87", 87, 2000, 83.5, 3.0, 14.0, 25.0),
    Turbine("II_III", "Vestas V100", 100, 2000, 100.0, 3.5, 12.0, 20.0),
    Turbine("III", "Vestas V110", 110, 2000, 100.0, 4.0, 12.0, 20.0),
    Turbine("S", "Vestas V164", 164, 9500, 105.0, 3.5, 14.0, 25.0),
)

#: First speed of each curve (m/s) and its power (kW) every 0.5 m/s.
STEP = 0.5
CURVES: dict[str, tuple[float, tuple[int, ...]]] = {
    "I": (1.5, (0, 2, 10, 18, 37, 56, 91, 127, 183, 240, 320, 400, 513, 626, 759, 892, 1058, 1223, 1407, 1590, 1745, 1900, 1990, 2080, 2155, 2230, 2265, 2300)),
    "I_II": (3.0, (0, 20, 40, 76, 113, 163, 213, 300, 388, 513, 639, 802, 965, 1133, 1300, 1434, 1568, 1670, 1772, 1843, 1913, 1943, 1973, 1987, 2000)),
    "II": (2.5, (0, 15, 42, 70, 114, 158, 208, 258, 358, 457, 631, 805, 969, 1132, 1300, 1468, 1609, 1750, 1825, 1900, 1950, 1990, 1995, 2000)),
    "II_III": (3.0, (0, 49, 97, 183, 268, 369, 470, 580, 722, 900, 1103, 1315, 1526, 1705, 1883, 1940, 1980, 1995, 2000)),
    "III": (3.5, (0, 44, 120, 195, 299, 403, 538, 673, 925, 1176, 1520, 1728, 1841, 1894, 1950, 1980, 1990, 2000)),
    "S": (3.5, (115, 249, 430, 613, 900, 1226, 1600, 2030, 2570, 3123, 3784, 4444, 5170, 5900, 6600, 7299, 7960, 8601, 9080, 9272, 9410, 9500)),
}


def turbine(iec_class: str) -> Turbine:
    """The specification of a class; I/II and II/III are accepted for I_II and II_III."""
    wanted = iec_class.replace("/", "_")
    for t in TURBINES:
        if t.iec_class == wanted:
            return t
    raise ValueError(f"unknown turbine class {iec_class!r}; known are {', '.join(t.iec_class for t in TURBINES)}")


class Piece(NamedTuple):
    """y + t (m + t (c + t b)) for t = speed - x."""

    x: float
    y: float
    m: float
    c: float
    b: float


def _end_slope(near: float, far: float) -> float:
    """One-sided three-point slope at an end of a uniform row, held to the shape of the data."""
    m = (3 * near - far) / 2
    if m * near <= 0:
        return 0.0
    return 3 * near if near * far <= 0 and abs(m) > abs(3 * near) else m


@lru_cache
def pieces(iec_class: str) -> tuple[Piece, ...]:
    """Monotone piecewise cubic (Fritsch-Butland slopes) through a class's curve."""
    first, power = CURVES[turbine(iec_class).iec_class]
    rise = [(b - a) / STEP for a, b in zip(power, power[1:])]
    inner = [0.0 if p * q <= 0 else 2 / (1 / p + 1 / q) for p, q in zip(rise, rise[1:])]
    slope = [_end_slope(rise[0], rise[1]), *inner, _end_slope(rise[-1], rise[-2])]
    return tuple(Piece(first + STEP * k, float(power[k]), slope[k], (3 * rise[k] - 2 * slope[k] - slope[k + 1]) / STEP, (slope[k] - 2 * rise[k] + slope[k + 1]) / STEP**2) for k in range(len(rise)))


def dim_turbine(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TURBINES), "iec_class string, model string, rotor_diameter int, rated_power int, hub_height double, cut_in double, rated_speed double, cut_out double")


def dim_power_curve(spark: SparkSession) -> DataFrame:
    rows = [(c, first + STEP * k, float(p)) for c, (first, power) in CURVES.items() for k, p in enumerate(power)]
    return spark.createDataFrame(rows, "iec_class string, wind_speed double, power double")

"""Scalar functions on columns: humidity, wind, angles, units, rotation of the pole."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants of the formulas and units.
KELVIN = 273.15
SECONDS_A_DAY = 86400.0
KMH_A_MS = 3.6

#: (from, to) unit pairs and their factor and offset: new = old * factor + offset.
CONVERSIONS = {
    ("K", "C"): (1.0, -KELVIN),
    ("C", "K"): (1.0, KELVIN),
    ("kg m-2 s-1", "mm"): (SECONDS_A_DAY, 0.0),
    ("mm", "kg m-2 s-1"): (1 / SECONDS_A_DAY, 0.0),
    ("m s-1", "km h-1"): (KMH_A_MS, 0.0),
    ("km h-1", "m s-1"): (1 / KMH_A_MS, 0.0),
}


def convert(value: Column, old: str, new: str) -> Column:
    """Value in new units; the same units leave it as it is."""
    if old == new:
        return value
    try:
        factor, offset = CONVERSIONS[old, new]
    except KeyError:
        raise ValueError(f"no conversion from {old} to {new}") from None
    scaled = value if factor == 1 else value / (1 / factor) if factor < 1 else value * F.lit(factor)
    return scaled if offset == 0 else scaled + F.lit(offset)


def rate_to_amount(rate: Column) -> Column:
    return rate * F.lit(SECONDS_A_DAY)


def vapour_pressure(t: Column) -> Column:
    """hPa, of a temperature in C."""
    return F.lit(6.11) * F.pow(F.lit(10.0), F.lit(7.5) * t / (F.lit(237.7) + t))


def specific_humidity(dew_point_k: Column, pressure_pa: Column) -> Column:
    e = vapour_pressure(dew_point_k - F.lit(KELVIN))
    return F.lit(0.622) * e / (pressure_pa / F.lit(100.0) - F.lit(0.378) * e)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_from_components(u: Column, v: Column, calm: float = 0.5) -> tuple[Column, Column]:
    """Speed, and the direction the wind comes from in whole degrees: 0 if calm, 360 from the north."""
    speed = wind_speed(u, v)
    direction = F.round(F.pmod(F.lit(270.0) - F.degrees(F.atan2(v, u)), F.lit(360.0)))
    return speed, F.when(speed < calm, 0.0).when(direction == 0, 360.0).otherwise(direction)


def components_from_wind(speed: Column, direction: Column) -> tuple[Column, Column]:
    angle = F.radians(F.pmod(F.lit(270.0) - direction, F.lit(360.0)))
    return speed * F.cos(angle), speed * F.sin(angle)


def angle_between(a: Column, b: Column) -> Column:
    """The shorter arc between two directions."""
    arc = F.pmod(F.abs(b - a), F.lit(360.0))
    return F.when(arc > 180, 360.0 - arc).otherwise(arc)


def circular_mean(direction: Column) -> Column:
    """Aggregate: direction of the mean of unit vectors, 0 to 360."""
    angle = F.radians(direction)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle)))), F.lit(360.0))


def within_bounds(x: Column, low: float, high: float) -> Column:
    """Between two bounds of longitude; a span of half the circle or more means the other side."""
    lo, hi = (high, low) if abs(high - low) >= 180 else (low, high)
    return x.between(lo, hi)


def rotate_pole(lon: Column, lat: Column, pole_lon: float, pole_lat: float, to_rotated: bool) -> tuple[Column, Column]:
    """Longitude and latitude on a sphere turned so that its south pole lies at the given point, or back."""
    theta, phi = math.radians(90 + pole_lat), math.radians(pole_lon)
    lo, la = F.radians(lon), F.radians(lat)
    x, y, z = F.cos(lo) * F.cos(la), F.sin(lo) * F.cos(la), F.sin(la)
    c, s, cp, sp = math.cos(theta), math.sin(theta), math.cos(phi), math.sin(phi)
    if to_rotated:
        along, across = x * cp + y * sp, y * cp - x * sp
        nx, ny, nz = along * c + z * s, across, z * c - along * s
    else:
        along, ny = x * c - z * s, y
        nz = x * s + z * c
        nx, ny = along * cp - ny * sp, along * sp + ny * cp
    return F.degrees(F.atan2(ny, nx)), F.degrees(F.asin(F.greatest(F.least(nz, F.lit(1.0)), F.lit(-1.0))))


def clamp(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Values below low become low, above high become high; NULL stays NULL."""
    out = value
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def step_noise(*step: str, seed: int = 42) -> Column:
    """A number from 0 to 1, the same for all cells of a step (such as a simulation's day) and in every run."""
    return F.xxhash64(F.lit(seed), *step).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def perturb(value: Column, *step: str, size: float = 1e-12, seed: int = 42) -> Column:
    """Add noise from 0 to size, one draw for each step, to break ties before ranks are taken."""
    return value + step_noise(*step, seed=seed) * F.lit(size)

"""Column expressions for winds, precipitation, coordinates and missing values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Standard gravity and the mean radius of the Earth in km.
GRAVITY, EARTH_KM = 9.80665, 6371.0088


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column, calm: float | None = 0.0) -> Column:
    """Degrees the wind comes from, in [0, 360); null if a component is. calm: the direction of no wind, or None to leave
    it to the formula (270)."""
    angle = F.pmod(F.lit(270.0) - F.degrees(F.atan2(v, u)), F.lit(360.0))
    out = F.when(u.isNull() | v.isNull(), F.lit(None).cast("double"))
    if calm is not None:
        out = out.when((u == 0) & (v == 0), F.lit(float(calm)))
    return out.otherwise(F.when((u == 0) & (v == 0), F.lit(270.0)).otherwise(angle))


def total_precipitation(large_scale: Column, convective: Column) -> Column:
    return large_scale + convective


def geopotential_height(z: Column) -> Column:
    """Metres, none below 0."""
    return clip_low(z / GRAVITY, 0.0)


def clip_low(x: Column, low: float) -> Column:
    """x or low, the larger; null stays null."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def log10_1p(x: Column) -> Column:
    return F.log10(x + 1)


def longitude_360(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def longitude_180(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    north, east = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = north * north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east * east
    return EARTH_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def sentinels_to_null(x: Column, missing: float = -999.0, no_coverage: float = -99.0, below: float = -90.0) -> Column:
    return F.when((x == missing) | (x == no_coverage) | (x < below), None).otherwise(x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def albers_constants() -> dict[str, float]:
    """Of the conterminous-US equal-area conic projection: standard parallels 29.5 and 45.5 N, origin 23 N 96 W, GRS 80."""
    a, e2 = 6378137.0, 0.0066943800229  # fixed values of the ellipsoid
    e = math.sqrt(e2)

    def area(deg: float) -> float:
        s = math.sin(math.radians(deg))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def width(deg: float) -> float:
        return math.cos(math.radians(deg)) / math.sqrt(1 - e2 * math.sin(math.radians(deg)) ** 2)

    n = (width(29.5) ** 2 - width(45.5) ** 2) / (area(45.5) - area(29.5))
    c = width(29.5) ** 2 + n * area(29.5)
    return {"a": a, "e": e, "e2": e2, "n": n, "c": c, "rho0": a * math.sqrt(c - n * area(23.0)) / n}


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x and y in metres of the equal-area projection."""
    k = albers_constants()
    s = F.sin(F.radians(lat))
    area = (1 - k["e2"]) * (s / (1 - k["e2"] * s * s) - F.log((1 - k["e"] * s) / (1 + k["e"] * s)) / (2 * k["e"]))
    rho = k["a"] * F.sqrt(k["c"] - k["n"] * area) / k["n"]
    theta = k["n"] * F.radians(lon + 96.0)
    return rho * F.sin(theta), k["rho0"] - rho * F.cos(theta)

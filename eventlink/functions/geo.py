"""Coordinate expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Locate-system code → system name.  Any other code counts as Gps.
SYSTEMS = {0: "Gps", 1: "Bd", 2: "Gd"}

# WGS84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563


def system_name(code: Column) -> Column:
    out = F.lit("Gps")
    for number, name in SYSTEMS.items():
        if name != "Gps":
            out = F.when(code == number, name).otherwise(out)
    return out


def lonlat_text(lon: Column, lat: Column) -> Column:
    return F.concat_ws(",", lon.cast("string"), lat.cast("string"))


def split_lonlat(text: Column) -> tuple[Column, Column]:
    parts = F.split(text, ",", -1)
    return tuple(F.try_element_at(parts, F.lit(i)).try_cast("double") for i in (1, 2))


def transverse_mercator(
    lon: Column,
    lat: Column,
    central_meridian: float,
    scale: float = 1.0,
    false_easting: float = 500000.0,
) -> tuple[Column, Column]:
    """Plane (x east, y north) in metres; series of Snyder, Map Projections (1987), eq. 8-9 to 8-13."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = F.radians(lat)
    n = F.lit(SEMI_MAJOR) / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
    t = F.tan(phi) * F.tan(phi)
    c = ep2 * F.cos(phi) * F.cos(phi)
    a = (lon - central_meridian) * (math.pi / 180) * F.cos(phi)
    m = SEMI_MAJOR * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi)
        - (35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    a2, a3, a4, a5, a6 = a * a, a * a * a, a * a * a * a, a * a * a * a * a, a * a * a * a * a * a
    x = scale * n * (a + (1 - t + c) * a3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a5 / 120)
    y = scale * (
        m
        + n
        * F.tan(phi)
        * (
            a2 / 2
            + (5 - t + 9 * c + 4 * c * c) * a4 / 24
            + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a6 / 720
        )
    )
    return x + false_easting, y


def plausible(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """True where x and y are set, finite and within ``(x_min, x_max, y_min, y_max)``."""
    x_min, x_max, y_min, y_max = bounds
    inside = x.between(x_min, x_max) & y.between(y_min, y_max)
    return F.coalesce(inside & ~F.isnan(x) & ~F.isnan(y), F.lit(False))

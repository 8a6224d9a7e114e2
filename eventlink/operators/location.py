"""Coordinate correction and location joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlink.functions.geo import plausible, system_name, transverse_mercator
from eventlink.operators.clean import nonzero_lonlat
from eventlink.operators.nearest import nearest_join
from eventlink.operators.session_joins import session_nearest_start

# Bound of the location join unless given, in seconds.
LOCATION_BOUND = 30

# Groups over which rows are spread that need no correction.
SPREAD = 4096


def to_gps(
    df: DataFrame,
    grid: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    system: str = "locate_system",
    cell: float = 0.1,
) -> DataFrame:
    """Convert lon/lat to Gps by a correction grid; adds ``converted``.

    ``grid`` has system, cell_x, cell_y, dlon, dlat, one row per cell of ``cell`` degrees.  Gps positions
    pass through.  Elsewhere the cell's offsets are added and the sum rounded to 6 decimals; without
    a cell, or if a result is 0, the conversion has failed: ``converted`` is false and lon, lat null.

    There is no broadcast hint: Spark broadcasts the grid while its measured size is under the
    session's threshold and sort-merges beyond it.  For that case rows that need no cell (Gps, or no
    position at all) are spread by a hash, so that they do not meet in one task; a crowded cell is
    left to Spark's skew join.
    """
    per = round(1 / cell)
    g = grid.select(
        F.col("system").alias("_system"),
        F.col("cell_x").alias("_x"),
        F.col("cell_y").alias("_y"),
        F.lit(0).alias("_one"),
        "dlon",
        "dlat",
    )
    rows = df.withColumn("_sys", system_name(F.coalesce(F.col(system), F.lit(0))))
    needs = (F.col("_sys") != "Gps") & F.col(lon).isNotNull() & F.col(lat).isNotNull()
    away = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int") + 1
    rows = rows.withColumn("_spread", F.when(needs, 0).otherwise(away))
    on = (
        (F.col("_sys") == F.col("_system"))
        & (F.floor(F.col(lon) * per) == F.col("_x"))
        & (F.floor(F.col(lat) * per) == F.col("_y"))
        & (F.col("_spread") == F.col("_one"))
    )
    new_lon, new_lat = F.round(F.col(lon) + F.col("dlon"), 6), F.round(F.col(lat) + F.col("dlat"), 6)
    gps = F.col("_sys") == "Gps"
    ok = F.coalesce((new_lon != 0.0) & (new_lat != 0.0), F.lit(False))
    rows = rows.join(g, on, "left").withColumn("converted", gps | ok)
    out = {
        lon: F.when(gps, F.col(lon)).when(ok, new_lon),
        lat: F.when(gps, F.col(lat)).when(ok, new_lat),
    }
    return rows.withColumns(out).drop(
        "_sys", "_system", "_x", "_y", "_spread", "_one", "dlon", "dlat"
    )


def project(df: DataFrame, central_meridian: float, lon="lon", lat="lat") -> DataFrame:
    x, y = transverse_mercator(F.col(lon), F.col(lat), central_meridian)
    return df.withColumns({"x": x, "y": y})


def normal_xy(df: DataFrame, bounds) -> DataFrame:
    """Only rows whose x and y are set, finite and within the bounds."""
    return df.where(plausible(F.col("x"), F.col("y"), bounds))


def nearest_location(
    obs: DataFrame,
    locations: DataFrame,
    grid: DataFrame,
    on: list[str],
    bound=LOCATION_BOUND,
    convert_first: bool = False,
    how: str = "left",
    **kw,
) -> DataFrame:
    """Give each observation the lon/lat of the location nearest in time, in Gps coordinates.

    By default the nearest location is chosen first; if it cannot be converted the row is unmatched and
    ``converted`` is false.  With ``convert_first`` locations that cannot be converted do not take part.
    Either way the locations are converted once, and the observations never meet the grid.
    """
    refs = to_gps(locations.where(nonzero_lonlat()), grid)
    if convert_first:
        refs = refs.where("converted")
    out = nearest_join(obs, refs, on, bound, ["lon", "lat", "converted"], **kw)
    return out.where(F.col("lon").isNotNull()) if how == "inner" else out


def session_location(
    obs: DataFrame, locations: DataFrame, grid: DataFrame, on: list[str], bound=LOCATION_BOUND, **kw
) -> DataFrame:
    """Sessions take the convertible location nearest to their start; other sessions are dropped."""
    refs = to_gps(locations.where(nonzero_lonlat()), grid).where("converted")
    return session_nearest_start(obs, refs, on, bound, ["lon", "lat"], how="inner", **kw)

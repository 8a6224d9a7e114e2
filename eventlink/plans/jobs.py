"""Whole jobs, composed from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventlink.functions.ids import has_id, hashed_id, site_of
from eventlink.functions.times import micros
from eventlink.operators import quality as Q
from eventlink.operators.clean import split_bad, time_range, valid_location, valid_reference
from eventlink.operators.location import (
    LOCATION_BOUND,
    nearest_location,
    normal_xy,
    project,
)
from eventlink.operators.merge import merge_arrays
from eventlink.operators.nearest import keep_or_fill, nearest_join
from eventlink.sources.folders import stored, write_hours

# Defaults of the backfill job, in seconds and rows.
BACKFILL_BOUND = 30
MERGE_KEYS = ["ts", "eci", "mme_ue_s1ap_id", "mme_group_id", "mme_code"]
KEYS = ["site", "mme_ue_s1ap_id"]

# Any conversion from raw input to columns; DataFrame expressions where possible.
Decode = Callable[[DataFrame], DataFrame]


def with_site(df: DataFrame) -> DataFrame:
    return df.withColumn("site", site_of(F.col("eci")))


def backfill(
    obs: DataFrame,
    ref: DataFrame | None,
    on: list[str] = KEYS,
    bound=BACKFILL_BOUND,
    ref_id: str = "id",
    ref_time: str = "start_ts",
    ref_range: tuple[dt.datetime | None, dt.datetime | None] = (None, None),
    merge: bool = False,
    decode_obs: Decode = with_site,
    decode_ref: Decode = with_site,
    **nearest,
) -> DataFrame:
    """All observations with ``id`` filled in from the nearest reference, ``matched``, ``distance``.

    Observations that could not be decoded (``is_bad``, where there is such a column) are left out.
    References need both times and an id, and a start within ``ref_range`` (inclusive) if that is given.
    Without references every observation passes with the id it has.
    """
    obs = decode_obs(obs)
    if "is_bad" in obs.columns:
        obs, _ = split_bad(obs)
    if merge:
        rest = [c for c in obs.columns if c not in {*MERGE_KEYS, "nc_cells", "nc_rsrp"}]
        order = ["row_id"]
        obs = merge_arrays(obs, MERGE_KEYS, ["nc_cells", "nc_rsrp"], order, rest)
    if ref is None:
        return obs.withColumns(
            {"distance": F.lit(None).cast("long"), "matched": F.lit(False)}
        )
    ref = decode_ref(time_range(ref.where(valid_reference()), ref_time, *ref_range))
    out = nearest_join(
        obs, ref, on, bound, {"_found": ref_id}, ref_time=ref_time, distance="distance", **nearest
    )
    out = out.withColumn("matched", F.col("_found").isNotNull())
    return keep_or_fill(out, "id", "_found")


def backfill_output(filled: DataFrame) -> DataFrame:
    """The rows the backfill job writes: those that have an id."""
    return filled.where(has_id(F.col("id")))


def backfill_outcomes(obs: DataFrame, ref: DataFrame | None, **args) -> DataFrame:
    """Every observation that was read, with its ``outcome``: ``filled``, ``unmatched`` or ``bad``.

    ``obs`` has ``is_bad`` (null counts as bad), and with it whatever tells why; those columns stay.  Bad rows never meet a reference.
    """
    bad = F.coalesce(F.col("is_bad"), F.lit(True))
    filled = backfill(obs.where(~bad), ref, **args)
    outcome = F.when(F.col("matched"), "filled").otherwise("unmatched")
    return filled.withColumn("outcome", outcome).unionByName(
        obs.where(bad).drop("is_bad").withColumns({"matched": F.lit(False), "outcome": F.lit("bad")}), allowMissingColumns=True
    )


def write_outcomes(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """One write with a folder for each outcome, large ones in several files."""
    df.hint("rebalance", "outcome").write.mode("overwrite").options(**options).partitionBy("outcome").format(fmt).save(path)


def attach_location(
    obs: DataFrame,
    locations: DataFrame,
    grid: DataFrame,
    central_meridian: float,
    on: list[str] = ("id",),
    bound=LOCATION_BOUND,
    location_time: str = "start_ts",
    location_range: tuple[dt.datetime | None, dt.datetime | None] = (None, None),
    **nearest,
) -> DataFrame:
    """Observations that have an id, with lon, lat, x, y of the nearest location (null if none)."""
    refs = time_range(locations.where(valid_location()), location_time, *location_range)
    out = nearest_location(
        obs.where(has_id(F.col("id"))),
        refs,
        grid,
        list(on),
        bound,
        ref_time=location_time,
        **nearest,
    )
    return project(out, central_meridian)


def location_output(located: DataFrame, xy_bounds) -> DataFrame:
    """The rows the location job writes: those with a usable x/y."""
    return normal_xy(located, xy_bounds)


def chain(
    obs, ref, locations, grid, central_meridian, xy_bounds, backfill_args=None, location_args=None
) -> DataFrame:
    """Backfill, then location.

    The location join reads its observations twice (for their times and for the rows), so the filled ones
    are a table of the scratch folder in between.
    """
    filled = backfill_output(backfill(obs, ref, **(backfill_args or {})))
    filled = stored(filled.drop("distance", "matched"), "filled")
    located = attach_location(filled, locations, grid, central_meridian, **(location_args or {}))
    return location_output(located, xy_bounds)


def has_time(df: DataFrame, time: str = "ts") -> Column:
    return micros(df, time).isNotNull()


def backfill_report(raw_obs, raw_ref, filled, ref_time="start_ts", ref_range=(None, None)) -> DataFrame:
    """Counters of a backfill run; ``raw_obs`` has a boolean ``is_bad``.

    References are counted within the range that the run used.
    """
    in_range = time_range(raw_ref, ref_time, *ref_range)
    return Q.report(
        "backfill",
        obs=(raw_obs, Q.ok_bad("rows_ok", "rows_bad", F.col("is_bad"))),
        ref=(in_range, Q.ok_bad("refs_ok", "refs_bad", ~valid_reference())),
        out=(
            filled,
            {
                "rows_merged": F.count(F.lit(1)),
                **Q.match_counts(F.col("matched"), has_time(filled)),
            },
        ),
    )


def location_report(raw_obs, raw_locations, located) -> DataFrame:
    """Counters of a location run; an observation without an id is a bad row."""
    return Q.report(
        "location",
        obs=(raw_obs, Q.ok_bad("rows_ok", "rows_bad", ~has_id(F.col("id")))),
        ref=(raw_locations, Q.ok_bad("refs_ok", "refs_bad", ~usable_location())),
        out=(
            located,
            {
                "rows_merged": F.count(F.lit(1)),
                **Q.match_counts(F.col("lon").isNotNull(), has_time(located)),
                **Q.conversion_counts(),
            },
        ),
    )


def usable_location() -> Column:
    return valid_location() & (F.col("lon") != 0.0) & (F.col("lat") != 0.0)


def write_run(df: DataFrame, path: str, salt: str | None = None, **sink) -> None:
    """Write a job's rows to day/hour folders, with a keyed hash in place of the id if asked."""
    if salt is not None:
        df = df.withColumn("id", hashed_id(F.col("id"), salt))
    write_hours(df, path, **sink)


def counted(filled: DataFrame) -> tuple[DataFrame, Observation]:
    """Match counters of a run that are collected while its rows are written."""
    counters = Q.match_counts(F.col("matched"), has_time(filled))
    return Q.observed(filled, {"rows_merged": F.count(F.lit(1)), **counters})


def counted_backfill(
    obs: DataFrame,
    ref: DataFrame,
    ref_time: str = "start_ts",
    ref_range: tuple[dt.datetime | None, dt.datetime | None] = (None, None),
    decode_obs: Decode = with_site,
    decode_ref: Decode = with_site,
    **args,
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """A backfill run that reads each raw side once, and its counters, those of :func:`backfill_report`.

    Each side is counted while what is usable of it is written to the scratch folder; the join, which needs
    observations twice, reads those tables.  The match is counted while the result is written: call the counters after that.
    """
    raw_obs, of_obs = Q.observed(decode_obs(obs), Q.ok_bad("rows_ok", "rows_bad", F.col("is_bad")))
    good = stored(raw_obs.where(~F.coalesce(F.col("is_bad"), F.lit(True))).drop("is_bad"), "observations")
    valid = valid_reference(start=ref_time)
    raw_ref, of_ref = Q.observed(time_range(ref, ref_time, *ref_range), Q.ok_bad("refs_ok", "refs_bad", ~valid))
    refs = stored(decode_ref(raw_ref.where(valid)), "references")
    ready = dict(decode_obs=lambda df: df, decode_ref=lambda df: df)
    out, of_out = counted(backfill(good, refs, ref_time=ref_time, **ready, **args))
    return out, lambda: {**of_obs.get, **of_ref.get, **of_out.get}


def counted_location_run(
    obs: DataFrame,
    locations: DataFrame,
    grid: DataFrame,
    central_meridian: float,
    location_time: str = "start_ts",
    location_range: tuple[dt.datetime | None, dt.datetime | None] = (None, None),
    **args,
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """As :func:`counted_backfill`, for a location run; the counters are those of :func:`location_report`."""
    named = has_id(F.col("id"))
    raw_obs, of_obs = Q.observed(obs, Q.ok_bad("rows_ok", "rows_bad", ~named))
    good = stored(raw_obs.where(named), "observations")
    usable = usable_location()
    in_range = time_range(locations, location_time, *location_range)
    raw_ref, of_ref = Q.observed(in_range, Q.ok_bad("refs_ok", "refs_bad", ~usable))
    refs = stored(raw_ref.where(usable), "references")
    located = attach_location(good, refs, grid, central_meridian, location_time=location_time, **args)
    out, of_out = counted_locations(located)
    return out, lambda: {**of_obs.get, **of_ref.get, **of_out.get}


def counted_locations(located: DataFrame) -> tuple[DataFrame, Observation]:
    """As :func:`counted`, for a location run."""
    hits = Q.match_counts(F.col("lon").isNotNull(), has_time(located))
    counters = {"rows_merged": F.count(F.lit(1)), **hits, **Q.conversion_counts()}
    return Q.observed(located, counters)

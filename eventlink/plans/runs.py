"""Hourly runs of the jobs, and the hours that late references make necessary again.

Observations and references are tables with ``day`` and ``hour`` columns (folders, in production).  A run of one hour reads that
hour's observations and the references of the hours around it, and replaces that hour's folder of the output.  Several
hours are run as one job: a reference goes to each run that may use it, and the run's hour is a part of the key, so that
the result is that of the runs one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlink.functions.times import HOUR, MICROS, day_text, floor_div, hour_text, micros, span
from eventlink.plans import jobs
from eventlink.sources.folders import day_slice, hour_slice, stored, write_hours

RUN = ["day", "hour"]
MINUTE = 60 * MICROS


@dataclass(frozen=True)
class Around:
    """How many minutes before an hour and after its end a run's references may lie, both ends included.

    An advance of 0 means the default of 20.
    """

    advance_min: int = 20
    later_min: int = 0

    def reach(self) -> tuple[int, int]:
        """From the start of the run's hour to its first and last moment, in microseconds."""
        return -(self.advance_min or 20) * MINUTE, HOUR + self.later_min * MINUTE


def hour_inputs(
    obs: DataFrame, ref: DataFrame, day: str, hour, around: Around = Around(), ref_time: str = "start_ts"
) -> tuple[DataFrame, DataFrame]:
    """What a run of one hour reads; both filters reach the folders."""
    refs = hour_slice(ref, day, hour, around.advance_min, around.later_min, ref_time)
    return day_slice(obs, day, hour), refs.drop(*RUN)


def backfill_hour(obs, ref, day: str, hour, around: Around = Around(), ref_time="start_ts", **job) -> DataFrame:
    """One hour's observations with their ids, ``matched``, ``distance``; see :func:`jobs.backfill`."""
    mine, refs = hour_inputs(obs, ref, day, hour, around, ref_time)
    return jobs.backfill(mine, refs, ref_time=ref_time, **job)


def location_hour(
    obs, locations, grid, central_meridian, day: str, hour, around: Around = Around(), location_time="start_ts", **job
) -> DataFrame:
    """One hour's observations that have an id, with the nearest location; see :func:`jobs.attach_location`."""
    mine, refs = hour_inputs(obs, locations, day, hour, around, location_time)
    return jobs.attach_location(mine, refs, grid, central_meridian, location_time=location_time, **job)


def write_hour(df: DataFrame, path: str, day: str, hour, fmt: str = "parquet", **options) -> None:
    """Replace one hour's folder, also by an empty one; no other folder is touched."""
    rows = df.drop(*RUN)
    rows.write.mode("overwrite").options(**options).format(fmt).save(f"{path}/day={day}/hour={int(hour):02d}")


# --- several hours as one job -----------------------------------------------------------------------------


def _of_hour(start: Column) -> list[Column]:
    at = F.timestamp_micros(start).cast("timestamp_ntz")
    return [day_text(at).alias("day"), hour_text(at).alias("hour")]


def hours_of_day(spark: SparkSession, day: str) -> DataFrame:
    """The 24 hours of a day."""
    return spark.range(24).select(F.lit(day).alias("day"), F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def for_runs(ref: DataFrame, around: Around, time: str = "start_ts") -> DataFrame:
    """Each reference once for every run that may use it, with the run's ``day`` and ``hour``.

    That is two or three times for the usual look-around.  References without a time go to no run.
    """
    first, last = around.reach()
    at = micros(ref, time)
    hours = F.sequence(-floor_div(-(at - last), HOUR), floor_div(at - first, HOUR))
    run = ref.drop(*RUN).withColumn("_run", F.explode(hours))
    return run.select(*[c for c in run.columns if c != "_run"], *_of_hour(F.col("_run") * HOUR))


def backfill_hours(
    obs: DataFrame, ref: DataFrame, hours: DataFrame, around: Around = Around(), on=jobs.KEYS, ref_time="start_ts", **job
) -> DataFrame:
    """The runs of ``hours`` (day, hour; no more than a year or two of them) as one job.

    Observations and references are reduced to these hours by a join with the hours, which prunes folders at run time.
    """
    hours = F.broadcast(hours.select(*RUN).distinct())
    mine = obs.join(hours, RUN, "left_semi")
    refs = for_runs(ref, around, ref_time).join(hours, RUN, "left_semi")
    return jobs.backfill(mine, refs, on=[*RUN, *on], ref_time=ref_time, **job)


def hours_reached(
    late: DataFrame, around: Around = Around(), bound=jobs.BACKFILL_BOUND, time: str = "start_ts", offset=0
) -> DataFrame:
    """The hours (day, hour) whose runs the references in ``late`` can change.

    A run sees a reference that its look-around covers, and an observation takes one that is nearer than ``bound``
    seconds (after the shift by ``offset``).  An hour has to be run again if both hold for some reference.
    """
    first, last = around.reach()
    at = micros(late, time)
    reach = span(bound) - 1
    lo = F.greatest(-floor_div(-(at - last), HOUR), floor_div(at - span(offset) - reach, HOUR))
    hi = F.least(floor_div(at - first, HOUR), floor_div(at - span(offset) + reach, HOUR))
    reached = late.where(at.isNotNull()).select(lo.alias("lo"), hi.alias("hi")).where("lo <= hi").distinct()
    return reached.select(F.explode(F.sequence("lo", "hi")).alias("run")).distinct().select(*_of_hour(F.col("run") * HOUR))


def backfill_late(
    obs: DataFrame,
    ref: DataFrame,
    late: DataFrame,
    path: str,
    around: Around = Around(),
    within: DataFrame | None = None,
    fmt: str = "parquet",
    ref_time: str = "start_ts",
    bound=jobs.BACKFILL_BOUND,
    offset=0,
    finish=jobs.backfill_output,
    **job,
) -> DataFrame:
    """Run the hours that late references can change again and replace just their folders under ``path``.

    ``ref`` are all references, the late ones included.  ``within`` limits the hours (to those that have been run at all).
    ``finish`` makes the rows that are written of the job's.  Hours that come out empty get an empty folder.  Returns the
    hours that were run.
    """
    hours = hours_reached(late, around, bound, ref_time, offset)
    if within is not None:
        hours = hours.join(F.broadcast(within.select(*RUN).distinct()), RUN, "left_semi")
    hours = stored(hours, "hours")
    out = stored(
        finish(backfill_hours(obs, ref, hours, around, ref_time=ref_time, bound=bound, offset=offset, **job)), "rerun"
    )
    write_hours(out, path, fmt)
    for r in hours.join(out.select(*RUN).distinct(), RUN, "left_anti").toLocalIterator():
        write_hour(out.limit(0), path, r.day, r.hour, fmt)
    return hours

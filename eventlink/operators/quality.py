"""Match-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT = {
    "backfill": [
        "rows_ok",
        "rows_bad",
        "rows_merged",
        "refs_ok",
        "refs_bad",
        "matched",
        "unmatched",
        "no_time",
    ],
    "location": [
        "rows_ok",
        "rows_bad",
        "rows_merged",
        "refs_ok",
        "refs_bad",
        "matched",
        "unmatched",
        "no_time",
        "converted_ok",
        "converted_bad",
    ],
}


def count_of(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def ratio() -> Column:
    """Matched share; null when there was nothing to match."""
    total = F.col("matched") + F.col("unmatched")
    return F.try_divide(F.col("matched").cast("double"), total.cast("double"))


def report(kind: str, **parts: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """One row of counters.

    Each part is a DataFrame with counters to take from it.  Every part is reduced to one row by
    itself; the rows are then added up, so no part meets another in a join.
    """
    total = None
    for df, counters in parts.values():
        one = df.agg(*[c.alias(n) for n, c in counters.items()])
        total = one if total is None else total.unionByName(one, allowMissingColumns=True)
    names = REPORT[kind]
    for n in names:
        if n not in total.columns:
            total = total.withColumn(n, F.lit(None).cast("long"))
    summed = total.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
    return summed.withColumn("ratio", ratio())


def ok_bad(ok: str, bad: str, is_bad: Column) -> dict[str, Column]:
    """Both counts; a row whose flag is null is bad, so that they sum to the rows."""
    flag = F.coalesce(is_bad, F.lit(True))
    return {ok: F.count_if(~flag), bad: F.count_if(flag)}


def match_counts(hit: Column, has_time: Column) -> dict[str, Column]:
    return {
        "matched": count_of(hit),
        "unmatched": count_of(has_time & ~hit),
        "no_time": count_of(~has_time),
    }


def conversion_counts(converted: str = "converted") -> dict[str, Column]:
    return {
        "converted_ok": count_of(F.col(converted)),
        "converted_bad": count_of(~F.col(converted)),
    }


def session_counts(sessions: DataFrame, size: str, matched: str) -> DataFrame:
    """Sessions and rows by outcome, each session weighted by its size."""
    hit = F.coalesce(F.col(matched), F.lit(False))
    rows = F.coalesce(F.sum(F.when(hit, F.col(size))), F.lit(0)).cast("long")
    rest = F.coalesce(F.sum(F.when(~hit, F.col(size))), F.lit(0)).cast("long")
    return sessions.agg(
        F.count_if(hit).alias("sessions_matched"),
        F.count_if(~hit).alias("sessions_unmatched"),
        rows.alias("matched"),
        rest.alias("unmatched"),
    ).withColumn("ratio", ratio())


def observed(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Count while the rows pass on to a sink, instead of running the join a second time."""
    watch = Observation()
    return df.observe(watch, *[c.alias(n) for n, c in counters.items()]), watch

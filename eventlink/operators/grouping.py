"""Grouping and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_by_id(df: DataFrame, id: str, time: str) -> DataFrame:
    """Rows, first and last time per id; the rows without an id are the failures.

    For the rows themselves in time order see ``number_rows``.
    """
    return (
        df.groupBy(id)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(time).alias("first_ts"),
            F.max(time).alias("last_ts"),
        )
        .withColumn("is_matched", F.col(id).isNotNull())
    )


def id_totals(grouped: DataFrame) -> DataFrame:
    """Over the result of :func:`group_by_id`: rows with an id, rows without one, and distinct ids."""
    rows = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("n_rows"))), F.lit(0)).cast("long")
    return grouped.agg(
        rows(F.col("is_matched")).alias("n_success"),
        rows(~F.col("is_matched")).alias("n_fail"),
        F.count_if("is_matched").alias("n_ids"),
    )


def rows_per_key(df: DataFrame, on: list[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))


def sort_by_time(df: DataFrame, time: str, order: list[str]) -> DataFrame:
    """Global order: a range-partitioned sort, so every task holds one stretch of time."""
    return df.orderBy(time, *order)

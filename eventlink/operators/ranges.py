"""Cutting sorted rows by position, so that no key, no hour and no instant has to fit in one task.

Rows are partitioned by range of the columns they are sorted by, and get the number of their range.  Ranges are about
equally large whatever the data looks like: a key that holds a third of all rows spans a third of the ranges, even if
all its rows are of one time.  Windows run within range and key.  Only a key that spans several ranges needs something
from other ranges, and a range has two such keys at most, its first and its last.  So what is carried over is a table
of that size, and it is broadcast.

The number of a range is only known while the rows are dealt out.  It must be written with them before anything else
refers to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlink.operators.slicing import all_set

PART = "_part"


def ranged(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` partitioned by range of ``by``, with the number of the range in ``_part``."""
    return df.repartitionByRange(*by).withColumn(PART, F.spark_partition_id())


def spanning_keys(rows: DataFrame, on: list[str]) -> DataFrame:
    """The keys (without nulls) that have rows in several ranges: no more than there are ranges."""
    key = F.struct(*on)
    ends = rows.where(all_set(*on)).groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    ends = ends.select(PART, F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    return ends.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key.*")


def of_spanning_keys(rows: DataFrame, on: list[str]) -> DataFrame:
    """The rows of keys that span several ranges."""
    return rows.join(F.broadcast(spanning_keys(rows, on)), on, "left_semi")

"""Scans, hour folders and sinks."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.functions.times import day_text, hour_text, hours_between, reference_range
from eventlink.operators.clean import time_range
from eventlink.sources.schemas import GRID_FIELDS, struct


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    null_text: str = "\\N",
    name_filter: str | None = None,
    bad_records: bool = False,
    **options,
) -> DataFrame:
    """Delimited text under a folder, sub-folders included.

    Short lines leave the tail null.  ``name_filter`` is a glob on file names.  With ``bad_records`` the
    raw text of lines that do not fit the schema is kept in ``_corrupt_record``.  Small files are
    packed into splits by ``spark.sql.files.maxPartitionBytes``.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("sep", sep)
        .option("nullValue", null_text)
        .option("mode", "PERMISSIVE")
        .options(**options)
    )
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if bad_records:
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.schema(schema).csv(path)


def load_grid(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Correction grid from delimited files with the columns system, cell_x, cell_y, dlon, dlat."""
    return scan_delimited(spark, path, struct(GRID_FIELDS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    For a costly result that is used more than once: the columns read later are pruned, and a lost
    executor does not bring back the work that led to it.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_hour(df: DataFrame, time: str = "ts") -> DataFrame:
    return df.withColumns({"day": day_text(F.col(time)), "hour": hour_text(F.col(time))})


def hour_slice(df: DataFrame, day: str, hour, advance_min: int = 20, later_min: int = 0, time=None):
    """References an hourly run may use: the touched ``day``/``hour`` partitions, then the exact time.

    On a table partitioned by day and hour the first filter prunes folders.
    """
    first, last = reference_range(day, hour, advance_min, later_min)
    touched = F.lit(False)
    for d, h in hours_between(first, last):
        touched = touched | ((F.col("day") == d) & (F.col("hour") == h))
    df = df.where(touched)
    return time_range(df, time, first, last) if time else df


def day_slice(df: DataFrame, day: str | None = None, hour=None, time: str | None = None) -> DataFrame:
    """The whole table, one day, or one hour of it.

    With ``time`` the same span is also asked of that column, as literals that reach the scan of a table
    that is not partitioned by day.
    """
    if day is not None:
        df = df.where(F.col("day") == day)
    if hour is not None:
        df = df.where(F.col("hour") == f"{int(hour):02d}")
    if time and day is not None:
        first = dt.datetime.strptime(day, "%Y%m%d") + dt.timedelta(hours=int(hour or 0))
        size = dt.timedelta(days=1) if hour is None else dt.timedelta(hours=1)
        df = time_range(df, time, first, first + size - dt.timedelta(microseconds=1))
    return df


def hour_paths(root: str, day: str, hour, advance_min=20, later_min=0, nested=False) -> list[str]:
    """Folders ``root/yyyyMMddHH`` or ``root/yyyyMMdd/HH`` that an hourly run reads."""
    sep = "/" if nested else ""
    hours = hours_between(*reference_range(day, hour, advance_min, later_min))
    return [f"{root.rstrip('/')}/{d}{sep}{h}" for d, h in hours]


def read_hours(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    day: str,
    hour,
    advance_min: int = 20,
    later_min: int = 0,
    nested: bool = False,
    **scan,
) -> DataFrame:
    """Delimited text of the folders an hourly run reads, as they are found, with each row's file in ``_file``.

    The folders are one pattern, so those that are not there are no error; if none is, there are no rows.
    """
    parts = [p.removeprefix(root.rstrip("/") + "/") for p in hour_paths(root, day, hour, advance_min, later_min, nested)]
    try:
        rows = scan_delimited(spark, f"{root.rstrip('/')}/{{{','.join(parts)}}}", schema, **scan)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
        return rows.withColumn("_file", F.lit(None).cast("string"))
    return rows.select(*rows.columns, F.col("_metadata.file_path").alias("_file"))


def write_hours(df: DataFrame, path: str, fmt: str = "csv", by=("day", "hour"), **options) -> None:
    """Overwrite only the day/hour folders that occur in ``df``.

    The rebalance hint gives each folder few files and splits folders that are too large for one task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place that ``spark.checkpoint.dir`` names.

    A local session without that setting gets a checkpoint folder of its own, one for all its tables: a
    folder of one machine is no use to a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlink-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

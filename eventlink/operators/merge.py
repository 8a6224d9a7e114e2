"""Merging partial rows and tagging sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlink.operators.sessions import number_rows


def tagged_union(**sources: DataFrame) -> DataFrame:
    """One table of several kinds of records; ``kind`` is the argument name."""
    out = None
    for kind, df in sources.items():
        df = df.withColumn("kind", F.lit(kind))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def merge_arrays(
    df: DataFrame, keys: list[str], arrays: list[str], order: list[str], scalars: list[str] = ()
) -> DataFrame:
    """One row per key group: arrays concatenated in order, scalars of the group's first row.

    A merged group is one record, so it has to fit in one; for groups that might not, see
    :func:`merge_arrays_long`.
    """
    member = F.struct(*dict.fromkeys([*order, *arrays]))
    first = F.min_by(F.struct(*scalars), F.struct(*order)).alias("_first") if scalars else None
    grouped = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(member)).alias("_members"), *([first] if scalars else [])
    )
    return grouped.select(
        *keys,
        *[F.col("_first").getField(s).alias(s) for s in scalars],
        *[F.flatten(F.col("_members").getField(a)).alias(a) for a in arrays],
        F.size("_members").cast("long").alias("n_merged"),
    )


def merge_arrays_long(df: DataFrame, keys: list[str], arrays: list[str], order: list[str]) -> DataFrame:
    """The merged arrays as rows: keys, ``pos`` (1, 2, … in the group's order), one element of each array.

    No group is ever one record.  ``order[0]`` must be a whole number or a time; the arrays of a row are
    parallel, a shorter one gives nulls.
    """
    zipped = F.arrays_zip(*[F.col(a).alias(a) for a in arrays])
    rows = df.select(*dict.fromkeys([*keys, *order]), F.posexplode(zipped).alias("_at", "_element"))
    rows = rows.withColumn("_first", F.col(order[0]).cast("long"))
    rows = number_rows(rows, keys, "_first", [*order, "_at"], name="_place")
    return rows.select(*keys, F.col("_place").alias("pos"), *[F.col("_element").getField(a).alias(a) for a in arrays])

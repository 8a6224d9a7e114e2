"""Parsing, cleaning and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlink.functions.ids import ALL_ONES, NULL_TEXT, has_id
from eventlink.functions.times import NO_TIME_MS


def parse_delimited(
    df: DataFrame, line: str, fields: list[tuple[str, str]], sep: str = ",", keep: list[str] = ()
) -> DataFrame:
    """Split a line into typed fields.

    Empty tokens are kept, a short line leaves the tail null, and text that is not of the field's
    type becomes null and sets ``is_bad``.
    """
    tokens = F.split(F.col(line), "\\Q" + sep + "\\E", -1)
    df = df.withColumn("_tokens", tokens)
    bad, out = F.lit(False), []
    for i, (name, kind) in enumerate(fields):
        raw = F.try_element_at("_tokens", F.lit(i + 1))
        value = raw.try_cast(kind)
        bad = bad | (raw.isNotNull() & value.isNull())
        out.append(value.alias(name))
    return df.select(*keep, *out, bad.alias("is_bad"))


def split_bad(df: DataFrame, flag: str = "is_bad") -> tuple[DataFrame, DataFrame]:
    """Good rows and undecodable rows."""
    bad = F.coalesce(F.col(flag), F.lit(False))
    return df.where(~bad).drop(flag), df.where(bad)


def number_list(text: Column, sep: str = ";", kind: str = "int") -> Column:
    """``"1;2;3"`` → array; an empty text is an empty array."""
    items = F.transform(F.split(text, "\\Q" + sep + "\\E", -1), lambda x: x.try_cast(kind))
    return F.when(text == "", F.array().cast(f"array<{kind}>")).otherwise(items)


def neighbour_arrays(earfcn: Column, pci: Column, rsrp: Column) -> tuple[Column, Column]:
    """Three parallel text lists → ``nc_cells`` array<struct<earfcn,pci>> and ``nc_rsrp``."""
    cells = F.arrays_zip(number_list(earfcn).alias("earfcn"), number_list(pci).alias("pci"))
    return cells, number_list(rsrp, kind="double")


def neighbours_bad(*texts: Column, kinds=("int", "int", "double")) -> Column:
    """Whether a neighbour list holds something that is not a number; such a record cannot be decoded."""
    bad = F.lit(False)
    for text, kind in zip(texts, kinds):
        bad = bad | F.coalesce(F.exists(number_list(text, kind=kind), lambda x: x.isNull()), F.lit(False))
    return bad


def basic_columns(
    ts="ts",
    conn="mme_ue_s1ap_id",
    event="event_type",
    code="mme_code",
    cell="eci",
    group="mme_group_id",
    id="id",
) -> list[Column]:
    """The seven basic fields, texts never null."""
    text = {event, id}
    return [
        F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c)
        for c in (ts, conn, event, code, cell, group, id)
    ]


def valid_reference(start="start_ts", end="end_ts", id="id") -> Column:
    """Signalling reference with both raw times and an id."""
    known = F.col(id).isNotNull() & (F.col(id) != NULL_TEXT)
    return (F.col(start) != NO_TIME_MS) & (F.col(end) != NO_TIME_MS) & known


def valid_location(start="start_ts", end="end_ts", id="id") -> Column:
    """Location reference with both raw times and an id."""
    return (F.col(start) != NO_TIME_MS) & (F.col(end) != NO_TIME_MS) & has_id(F.col(id))


def no_sentinel(*cols: str) -> Column:
    """None of the columns is the all-ones number."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) != ALL_ONES)
    return cond


def nonzero_lonlat(lon="lon", lat="lat") -> Column:
    return (F.col(lon) != 0.0) & (F.col(lat) != 0.0)


def time_range(df: DataFrame, time: str, first: dt.datetime | None, last: dt.datetime | None):
    """Rows from first to last, both inclusive; no filter unless both are given.

    The bounds are literals of the column's own type, so the filter reaches the scan.
    """
    if not first or not last:
        return df
    kind = df.schema[time].dataType.simpleString()
    if kind == "bigint":
        epoch = dt.datetime(1970, 1, 1)
        lo, hi = (F.lit((x - epoch) // dt.timedelta(milliseconds=1)) for x in (first, last))
    else:
        lo, hi = (F.lit(x.isoformat(sep=" ")).cast(kind) for x in (first, last))
    return df.where(F.col(time).between(lo, hi))


def lookup(df: DataFrame, key: str, value, time: str, id: str) -> DataFrame:
    """Rows of one key: time in whole seconds (from raw milliseconds), key, id."""
    seconds = F.call_function("div", F.col(time), F.lit(1000)).alias("ts_s")
    return df.where(F.col(key) == value).select(seconds, key, id)

"""Time expressions.  Inside the library every time is a long count of microseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000
HOUR = 3600 * MICROS

UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")

# Fixed value: a raw epoch-millisecond time that means "no time".
NO_TIME_MS = -1


def span(value) -> int:
    """Seconds (number) or timedelta as whole microseconds."""
    if isinstance(value, dt.timedelta):
        return (value.days * 86400 + value.seconds) * MICROS + value.microseconds
    return round(value * MICROS)


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch for column ``name``.

    A long column is taken as raw epoch milliseconds, where -1 means missing.  A timestamp without
    zone is read as written, whatever the session zone is; under UTC that is a plain cast.
    """
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.when(col != NO_TIME_MS, col.cast("long") * 1000)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
            return F.unix_micros(col.cast("timestamp"))
        day = F.unix_date(col.cast("date")).cast("long") * (24 * HOUR)
        clock = (F.hour(col) * 60 + F.minute(col)).cast("long") * (60 * MICROS)
        return day + clock + (F.date_part(F.lit("SECOND"), col) * MICROS).cast("long")
    raise TypeError(f"{name}: {kind.simpleString()} is not a time")


def millis(df: DataFrame, name: str) -> Column:
    """Raw epoch milliseconds, -1 for a missing time."""
    return F.coalesce(floor_div(micros(df, name), 1000), F.lit(NO_TIME_MS)).cast("long")


def floor_div(col: Column, width) -> Column:
    """Integer floor division that stays in longs (no rounding through doubles)."""
    w = width if isinstance(width, Column) else F.lit(int(width)).cast("long")
    return F.call_function("div", col - F.pmod(col, w), w)


def parse_hour(day: Column, hour: Column) -> Column:
    """``20240115`` and ``7`` or ``07`` → 2024-01-15 07:00:00."""
    return F.to_timestamp_ntz(F.concat(day, F.lpad(hour, 2, "0")), F.lit("yyyyMMddHH"))


# The three below read a timestamp without zone as written, whatever the session zone is.


def day_text(ts: Column) -> Column:
    return F.date_format(ts.cast("date"), "yyyyMMdd")


def hour_text(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def short_day(ts: Column) -> Column:
    """Day with a two-digit year."""
    return F.date_format(ts.cast("date"), "yyMMdd")


def duration_text(ms: Column) -> Column:
    """Milliseconds as ``h:m:s`` without padding; hours may pass 24."""
    s = F.call_function("div", ms, F.lit(1000))
    parts = (
        F.call_function("div", s, F.lit(3600)),
        F.call_function("div", s, F.lit(60)) % 60,
        s % 60,
    )
    return F.concat_ws(":", *[p.cast("string") for p in parts])


# --- run parameters (literals known before the query starts) ------------------------------------


def hour_start(day: str, hour: str | int) -> dt.datetime:
    return dt.datetime.strptime(f"{day}{int(hour):02d}", "%Y%m%d%H")


def reference_range(day: str, hour, advance_min: int = 20, later_min: int = 0):
    """First and last moment (both inclusive) of the references an hourly run may use.

    An advance of 0 means the default of 20 minutes.
    """
    start = hour_start(day, hour)
    first = start - dt.timedelta(minutes=advance_min or 20)
    return first, start + dt.timedelta(minutes=60 + later_min)


def hours_between(first: dt.datetime, last: dt.datetime) -> list[tuple[str, str]]:
    """Every (day, hour) folder that the inclusive range touches."""
    at, out = first.replace(minute=0, second=0, microsecond=0), []
    while at <= last:
        out.append((at.strftime("%Y%m%d"), at.strftime("%H")))
        at += dt.timedelta(hours=1)
    return out

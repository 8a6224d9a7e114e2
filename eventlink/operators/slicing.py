"""Cutting the rows of a key into time slices, so that no key has to fit in one task.

Sessions, numbering and open-ended lookups need the rows of a key in time order.  A window over
the key alone puts a key that holds a third of the table into one task.  Here every key is cut at fixed
times; windows run inside a slice, and the little that crosses a slice border is carried over by a
second window over one row per slice.  The result is the same for any width, and the plan is the same
for any data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlink.functions.times import HOUR, floor_div


@dataclass(frozen=True)
class Slicing:
    """``width`` of the slices in microseconds.

    An hour leaves a usual key few slices and cuts one that is busy for a month into 720.  What is carried
    is one row per key and slice, so a width far below the usual distance of a key's rows only costs.
    """

    width: int = HOUR

    def step(self, at: str) -> Column:
        return floor_div(F.col(at), self.width)


def all_set(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def apart(df: DataFrame, on: list[str], at: str) -> tuple[DataFrame, DataFrame]:
    """Rows with key and time, and the others, which need no window and no shuffle."""
    usable = all_set(*on, at)
    return df.where(usable), df.where(~usable)

"""Identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers that mean "not set" in the raw records.
ALL_ONES = 4294967295
NULL_TEXT = "\\N"


def site_of(cell_id: Column) -> Column:
    """Site number of a cell number: the cell number without its lowest 8 bits."""
    return F.shiftright(cell_id, 8)


def has_id(col: Column) -> Column:
    return F.coalesce(col, F.lit("")) != ""


def hashed_id(col: Column, salt: str) -> Column:
    """Keyed hash of an id, for outputs that must not carry the id itself."""
    return F.sha2(F.concat(F.lit(salt), col), 256)

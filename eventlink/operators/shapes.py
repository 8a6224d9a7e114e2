"""Raw observation records of two shapes, told apart record by record.

A record is either ready, one line with all its fields, or five parallel lists: basic fields, serving cell, and the channel
numbers, cell numbers and levels of the neighbours.  Both become five arrays of text and are then put together in one way.
What cannot be put together is kept as it came, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlink.functions.values import let

#: The basic fields in the order both shapes have them.
BASIC = [
    ("ts", "bigint"),
    ("mme_ue_s1ap_id", "bigint"),
    ("event_type", "string"),
    ("mme_code", "int"),
    ("eci", "bigint"),
    ("mme_group_id", "int"),
    ("id", "string"),
]
SERVING = [("earfcn", "int"), ("pci", "int"), ("rsrp", "double")]
READY, LISTS = "P", "L"
FIELD, LIST, ITEM = ",", "|", ";"


def items(text: Column, sep: str = ITEM) -> Column:
    """The parts of a text; none of an empty one."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\\Q" + sep + "\\E", -1))


def five_lists(line: Column) -> Column:
    """basic, serving, earfcn, pci, rsrp of a line of either shape, arrays of text; null for any other line.

    A ready record is ``P``, the basic fields, the serving cell's and three lists; all with commas between.  The other
    shape is ``L`` and the five lists, with bars between them.
    """
    names = ["basic", "serving", "earfcn", "pci", "rsrp"]
    n, m = len(BASIC), len(SERVING)
    struct = lambda parts: F.struct(*[p.alias(name) for p, name in zip(parts, names)])

    def ready(f):
        lists = [items(F.get(f, F.lit(1 + n + m + i))) for i in range(3)]
        known = (F.get(f, F.lit(0)) == READY) & (F.size(f) == 1 + n + m + 3)
        return F.when(known, struct([F.slice(f, 2, n), F.slice(f, 2 + n, m), *lists]))

    def lists(f):
        known = (F.get(f, F.lit(0)) == LISTS) & (F.size(f) == 6)
        return F.when(known, struct([items(F.get(f, F.lit(1 + i))) for i in range(5)]))

    def either(text):
        return F.coalesce(let(F.split(text, FIELD, -1), ready), let(F.split(text, "\\Q" + LIST + "\\E", -1), lists))

    return let(line, either)


def _typed(array: Column, fields) -> list[Column]:
    """The texts as values; an empty text is a missing number."""
    return [F.get(array, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]


def _no_number(text: Column, kind: str) -> Column:
    return F.coalesce((text != "") & text.try_cast(kind).isNull(), F.lit(False))


def _no_number_of(kind: str):
    return lambda x: _no_number(x, kind)


def reason_of(five: Column) -> Column:
    """Why a record cannot be put together: ``shape``, ``fields``, ``lists`` (of uneven length) or ``number``; else null."""
    lists = [(five["earfcn"], "int"), (five["pci"], "int"), (five["rsrp"], "double")]
    uneven = (F.size(five["earfcn"]) != F.size(five["pci"])) | (F.size(five["pci"]) != F.size(five["rsrp"]))
    wrong = F.lit(False)
    for array, fields in ((five["basic"], BASIC), (five["serving"], SERVING)):
        for i, (_, kind) in enumerate(fields):
            wrong = wrong | _no_number(F.get(array, F.lit(i)), kind)
    for array, kind in lists:
        wrong = wrong | F.exists(array, _no_number_of(kind))
    short = (F.size(five["basic"]) != len(BASIC)) | (F.size(five["serving"]) != len(SERVING))
    found = F.when(five.isNull(), "shape").when(F.coalesce(short, F.lit(True)), "fields")
    return found.when(F.coalesce(uneven, F.lit(True)), "lists").when(F.coalesce(wrong, F.lit(True)), "number")


def assemble(five: Column) -> list[Column]:
    """The basic fields, the serving cell ``sc`` and the neighbours ``nc`` of a record without fault."""
    zipped = F.arrays_zip(five["earfcn"].alias("earfcn"), five["pci"].alias("pci"), five["rsrp"].alias("rsrp"))
    neighbours = F.transform(zipped, lambda x: F.struct(*[x[name].try_cast(kind).alias(name) for name, kind in SERVING]))
    return [*_typed(five["basic"], BASIC), F.struct(*_typed(five["serving"], SERVING)).alias("sc"), neighbours.alias("nc")]


def decode_observations(df: DataFrame, line: str = "line", keep: list[str] = ("row_id",)) -> DataFrame:
    """``keep``, the record of each line, ``is_bad``, and of bad ones ``reason`` and ``raw``, with all else null."""
    names = [name for name, _ in BASIC] + ["sc", "nc"]

    def record(five):
        reason = reason_of(five).alias("reason")
        return let(F.struct(reason, five.alias("five")), lambda x: F.struct(
            x["reason"].alias("reason"), F.when(x["reason"].isNull(), F.struct(*assemble(x["five"]))).alias("of")))

    df = df.select(*keep, F.col(line).alias("_line"), let(five_lists(F.col(line)), record).alias("_record"))
    reason = F.col("_record.reason")
    told = [reason.isNotNull().alias("is_bad"), reason.alias("reason"), F.when(reason.isNotNull(), F.col("_line")).alias("raw")]
    return df.select(*keep, *[F.col(f"_record.of.{name}").alias(name) for name in names], *told)

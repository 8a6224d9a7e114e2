"""What several operators of this package share: words, byte tokens, passes over texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.sources.folders import scratch_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: every ASCII character but digits and a-z (the text is in lower case by then).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that one pass of numpy works on; a longer document is a piece of its own.
PIECE = 1 << 21


# --- columns ------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """A-Z in lower case and nothing else; the plain function does for pure ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` and its lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(n))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts the lineage and outlives lost executors."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """A broadcast hint only where the counted rows are within the bound; else Spark shuffles."""
    return F.broadcast(df) if rows <= most else df


# --- passes over texts ----------------------------------------------------------------------------------


def texts_of(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array; the offsets start at 0."""
    n, at = len(column), column.offset
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[at : at + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[pa.Array]:
    """Runs of rows of about ``most`` bytes, in order, together the whole column."""
    _, offsets = raw(column)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = max(i + 1, min(j, len(column)))
        yield column.slice(i, j - i)
        i = j


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """``keep`` columns and new ones computed from whole texts, batch by batch, without a shuffle.

    ``make`` runs once in each task; what it returns gets a large_string array of some rows (null as
    empty text) and returns one array for each of ``fields``.  Columns go by position, so their names
    can't clash.
    """
    sel = df.select(F.col(text).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = [T.StructField(c, df.schema[c].dataType) for c in keep]
    schema = T.StructType([*kept, *fields])
    names = schema.names

    def run(batches):
        work = make()
        for batch in batches:
            at = 0
            for part in pieces(texts_of(batch.column(0))):
                own = [batch.column(k + 1).slice(at, len(part)) for k in range(len(kept))]
                at += len(part)
                yield pa.RecordBatch.from_arrays([*own, *work(part)], names=names)

    return sel.mapInArrow(run, schema)


# --- words of bytes ---------------------------------------------------------------------------------------


def _byte_table(true) -> np.ndarray:
    return np.array([bool(true(b)) for b in range(256)])


#: Digits, letters of ASCII and all bytes of other characters.
WORD_BYTE = _byte_table(lambda b: b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
#: All but space, tab, line feed, vertical tab, form feed and carriage return.
SOLID_BYTE = _byte_table(lambda b: not (b == 0x20 or 9 <= b <= 13))
TO_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M3)
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = int(_M3)) -> np.ndarray:
    """At least the first n powers of an odd base modulo 2**64."""
    if len(_POWERS.get(base, ())) < n:
        p = np.full(max(n, 1024), base, np.uint64)
        p[0] = 1
        _POWERS[base] = np.multiply.accumulate(p)
    return _POWERS[base]


# --- bit tables -------------------------------------------------------------------------------------------

#: A bit table has 32 bits for each hash, within these bounds; where it gets crowded more rows pass it and
#: reach the join behind it, which decides.
LEAST_BITS, MOST_BITS = 12, 21


def bit_table(hashes: DataFrame, n: int) -> Callable[[Column], Column]:
    """A test that the hashes in column ``h`` (about n of them) pass, and few others.

    The bits are a constant array of longs; what the driver collects for it is bounded whatever n is.
    """
    bits = max(LEAST_BITS, min(MOST_BITS, (32 * max(n, 1) - 1).bit_length()))
    place = F.pmod("h", F.lit(1 << bits))
    word, bit = F.shiftright(place, 6).cast("int"), F.pmod(place, F.lit(64)).cast("int")
    rows = hashes.select(word.alias("k"), bit.alias("b")).groupBy("k").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v"))
    table = [0] * (1 << bits - 6)
    for r in rows.toLocalIterator():
        table[r["k"]] = r["v"]
    packed = F.from_json(F.lit("[" + ",".join(map(str, table)) + "]"), "array<bigint>")

    def passes(h: Column) -> Column:
        place = F.pmod(h, F.lit(1 << bits))
        return F.getbit(F.get(packed, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1

    return passes


def tokens(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTE):
    """Words of the texts in ``buf``: (starts, ends, hashes, document of each word), in order.

    Words are maximal runs of ``inside`` bytes within a document, hashed with A-Z in lower case.
    """
    solid = inside[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(buf))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64), doc
    size = ends - starts
    begin = np.cumsum(size) - size
    own = TO_LOWER[buf[solid]]
    place = np.arange(len(own)) - np.repeat(begin, size)
    value = _BYTE_VALUE[own] * powers(int(size.max()) + 1)[place]
    return starts, ends, mix(np.add.reduceat(value, begin) + size.astype(np.uint64)), doc

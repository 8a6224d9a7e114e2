"""Raw text through a decoder of any kind, as a Spark data source.

A decoder is a Python function from lines to columns, for formats that no expression can read.  Files are cut into splits of
bytes, one Spark partition each; a split reads on from the first line that starts in it to the end of the last one that
does, and hands its rows over in Arrow batches.  Folders ``day=…`` and ``hour=…`` become columns, and filters on them are
asked before any file is opened.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

# Workers need not have this library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDERS = ("day", "hour")
SPLIT_BYTES = 64 << 20
#: Lines that are decoded together.
LINES = 10_000

#: Lines without their ends → the columns of the decoder's schema, one value a line.
Decoder = Callable[[list[str]], dict[str, list]]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[a-z0-9]+://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    values: tuple


def folder_values(path: str) -> tuple:
    return tuple(m[1] if (m := re.search(rf"/{name}=([^/]*)/", path)) else None for name in FOLDERS)


_TESTS = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
}


class DecodedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, decode: Decoder, options: dict):
        self.arrow, self.decode = to_arrow_schema(schema), decode
        self.path, self.split_bytes = options["path"], int(options.get("splitbytes", SPLIT_BYTES))
        self.filters: list[Filter] = []

    def _kept(self, values: tuple) -> bool:
        of = dict(zip(FOLDERS, values))
        return all(of[f.attribute[0]] is not None and _TESTS[type(f)](of[f.attribute[0]], f.value) for f in self.filters)

    def partitions(self) -> list[Split]:
        system, root = file_system(self.path)
        out = []
        for info in sorted(system.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            values = folder_values(info.path)
            if info.is_file and info.size and not info.base_name.startswith(("_", ".")) and self._kept(values):
                for start in range(0, info.size, self.split_bytes):
                    out.append(Split(info.path, start, min(start + self.split_bytes, info.size), values))
        return out or [Split("", 0, 0, (None,) * len(FOLDERS))]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if split.start == split.end:
            return
        system, _ = file_system(self.path)
        with system.open_input_file(split.path) as f:
            for lines in lines_of(f, split.start, split.end):
                columns = self.decode(lines)
                columns |= {name: [value] * len(lines) for name, value in zip(FOLDERS, split.values)}
                yield pa.RecordBatch.from_arrays([pa.array(columns[c.name], c.type) for c in self.arrow], schema=self.arrow)


class PruningReader(DecodedReader):
    """A reader for sessions that push filters; in others Spark refuses one that could take them."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of the folders' columns; the others are Spark's to apply."""
        for f in filters:
            if type(f) in _TESTS and f.attribute in [(name,) for name in FOLDERS]:
                self.filters.append(f)
            else:
                yield f


def lines_of(f, start: int, end: int, most: int = LINES, chunk: int = 1 << 20) -> Iterator[list[str]]:
    """The lines that start at ``start`` or later and before ``end``, in lists of up to ``most``."""
    at = max(start - 1, 0)  # the byte before tells whether a line starts just here
    f.seek(at)
    rest, skip, out = b"", start > 0, []
    while True:
        data = f.read(chunk)
        rest += data
        pieces = rest.split(b"\n")
        rest = pieces.pop()
        if not data and rest:  # the last line may have no end
            pieces, rest = [*pieces, rest], b""
        for piece in pieces:
            begin, at = at, at + len(piece) + 1
            if skip:
                skip = False
                continue
            if begin >= end:
                if out:
                    yield out
                return
            out.append(piece.removesuffix(b"\r").decode("utf-8", "replace"))
            if len(out) == most:
                yield out
                out = []
        if not data:
            if out:
                yield out
            return


def decoded(spark: SparkSession, path: str, schema: str, decode: Decoder, name: str = "decoded_text", **options):
    """All files under ``path`` through ``decode``, with ``day`` and ``hour`` of their folders (null without).

    Filters reach the folders where ``spark.sql.python.filterPushdown.enabled`` is set.  Files whose names start with ``_`` or
    ``.`` are left out.  The files must be plain text in a store that pyarrow knows.
    """
    whole = T.StructType([*T._parse_datatype_string(schema).fields, *[T.StructField(c, T.StringType()) for c in FOLDERS]])

    reads = PruningReader if spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" else DecodedReader

    class Decoded(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return whole

        def reader(self, schema):
            return reads(whole, decode, self.options)

    spark.dataSource.register(Decoded)
    return spark.read.format(name).options(**options).load(path)

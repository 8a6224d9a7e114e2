"""Removal of byte strings that occur more than once, by hash-compared suffix sorting.

Only places where a repeat is possible are sorted.  Every window of ``LENGTH`` bytes has an anchor: of its grams
of ``GRAM`` bytes the one with the smallest hash.  Equal windows have equal anchors at equal places, so only
windows of one anchor gram have to be compared.  Neighbouring windows with one anchor form a context.

An anchor gram that occurs once needs no more work.  If all its contexts have one hash (128 bits with the
gram's), all are repeated.  The others are compared: in each group the suffixes from the anchor onwards,
and the reversed prefixes before it, are sorted by a merge sort that compares two of them by their longest
common extension, found by binary search over prefix polynomial hashes.  Neighbours' common extensions are
verified byte by byte.  A window is repeated if another context agrees with it as far to the left and to the
right as it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import _BYTE_VALUE, bit_table, map_texts, mix, powers, raw, saved

LENGTH = 400
GRAM = 100
#: Contexts of one anchor that are sorted in one piece; more are dealt into pieces that exchange the
#: hashes of their windows.
PIECE_CONTEXTS = 4096
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_PLACE_BITS = np.uint64(24)
#: Bytes of one document that are looked at together; must stay below 2**24.
CHUNK = 4 << 20
RUNS = T.ArrayType(
    T.StructType(
        [
            T.StructField("s", T.LongType()),  # first window of the context, from the text's start
            T.StructField("off", T.IntegerType()),  # the anchor, from there
            T.StructField("n", T.IntegerType()),  # windows
            T.StructField("h", T.LongType()),
            T.StructField("c", T.LongType()),
        ]
    )
)


class Prefix:
    """Hashes of all substrings of ``buf``: prefix sums of byte values times powers, modulo 2**64."""

    def __init__(self, buf: np.ndarray, base: int, seed: int = 0):
        value = mix(_BYTE_VALUE + np.uint64(seed)) if seed else _BYTE_VALUE
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(value[buf] * powers(len(buf), base)[: len(buf)], out=self.sums[1:])
        self.back = powers(len(buf) + 1, pow(base, -1, 1 << 64))

    def of(self, at: np.ndarray, size) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.back[at]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    n = len(x)
    rows = -(-n // w)
    top = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    top[:n] = x
    top = top.reshape(rows, w)
    left = np.minimum.accumulate(top, axis=1).ravel()
    right = np.minimum.accumulate(top[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def contexts(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(document, first window, anchor - first, windows, gram hash, context hash) of texts below 2**24 bytes."""
    sizes = np.diff(offsets) - length + 1
    docs = np.flatnonzero(sizes > 0)
    if not len(docs):
        return [np.empty(0, np.int64)] * 6
    sizes, begin = sizes[docs], offsets[docs]
    one, two = Prefix(buf, _BASES[0]), Prefix(buf, _BASES[1], 1)
    place = np.arange(len(buf) - gram + 1)
    g = mix(one.of(place, gram))
    key = (g >> _PLACE_BITS << _PLACE_BITS) | place.astype(np.uint64)
    least = _sliding_min(key, length - gram + 1)
    shift = np.cumsum(sizes) - sizes
    start = np.arange(sizes.sum()) + np.repeat(begin - shift, sizes)
    doc = np.repeat(docs, sizes)
    anchor = (least[start] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(start)))
    s, a = start[at], anchor[at]
    c = mix(two.of(s, n - 1 + length) + n.astype(np.uint64) * np.uint64(_BASES[0]))
    return doc[at], s - offsets[doc[at]], a - s, n, g[a], c


def _runs(part: pa.Array, length: int, gram: int) -> pa.Array:
    buf, offsets = raw(part)
    if len(buf) <= CHUNK + length:
        found = contexts(buf, offsets, length, gram)
    else:  # one long document (or some, then each by itself)
        pieces = []
        for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            for i in range(a, max(b - length + 1, a), CHUNK):
                piece = buf[i : min(i + CHUNK + length - 1, b)]
                _, s, *rest = contexts(piece, np.array([0, len(piece)]), length, gram)
                pieces.append([np.full(len(s), d), s + (i - a), *rest])
        found = [np.concatenate(x) for x in zip(*pieces)] if pieces else [np.empty(0, np.int64)] * 6
    doc, s, off, n, h, c = found
    at = np.searchsorted(doc, np.arange(len(part) + 1))
    fields = [
        pa.array(s, pa.int64()),
        pa.array(off.astype(np.int32)),
        pa.array(n.astype(np.int32)),
        pa.array(h.astype(np.uint64).view(np.int64)),
        pa.array(c.astype(np.uint64).view(np.int64)),
    ]
    rows = pa.StructArray.from_arrays(fields, names=["s", "off", "n", "h", "c"])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)


# --- sorting ------------------------------------------------------------------------------------------------


class _Suffixes:
    """Strings ``buf[at : at + size]`` compared by their longest common extension."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, size: np.ndarray, seed: int):
        self.buf, self.at, self.size = buf, at, size
        self.hash = Prefix(buf, _BASES[seed % 2], seed + 2)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common start of strings x and y, by binary search over the hashes."""
        lo, hi = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.hash.of(self.at[x], mid) == self.hash.of(self.at[y], mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """x before y; of equal strings neither."""
        n = self.common(x, y)
        end_x, end_y = n >= self.size[x], n >= self.size[y]
        last = len(self.buf) - 1
        before = self.buf[np.minimum(self.at[x] + n, last)] < self.buf[np.minimum(self.at[y] + n, last)]
        return np.where(end_x, ~end_y, ~end_y & before)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the strings within each group (groups stand together): merge sort, all groups at once."""
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        size = np.searchsorted(group, group, side="right") - first
        order = np.arange(len(group))
        run = 1
        while run < size.max(initial=0):
            pair = place // (2 * run)  # two runs that become one
            right = (place // run) % 2 == 1
            lo = first + pair * 2 * run + np.where(right, 0, run)
            hi = np.minimum(lo + run, first + size)
            lo = np.minimum(lo, hi)
            start, own = lo.copy(), order
            while True:  # how many of the other run come before
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                other, me = order[mid], own[open_]
                before = np.where(right[open_], ~self.less(me, other), self.less(other, me))
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            to = first + pair * 2 * run + place % run + (lo - start)
            order = np.empty_like(order)
            order[to] = own
            run *= 2
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common start of each string with the one before it in the order, 0 at a group's first."""
        out = np.zeros(len(order), np.int64)
        same = np.flatnonzero(group[1:] == group[:-1]) + 1
        out[same] = self.common(order[same - 1], order[same])
        return out

    def verified(self, order: np.ndarray, common: np.ndarray) -> bool:
        """Whether all these common starts are equal byte by byte."""
        rows = np.flatnonzero(common)
        for i in range(0, len(rows), 2048):
            part = rows[i : i + 2048]
            n = common[part]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, y = np.repeat(self.at[order[part - 1]], n) + step, np.repeat(self.at[order[part]], n) + step
            if (self.buf[x] != self.buf[y]).any():
                return False
        return True


def _ranked(buf, at, size, group) -> tuple[np.ndarray, np.ndarray]:
    for seed in range(16):
        s = _Suffixes(buf, at, size, seed)
        order = s.sort(group)
        common = s.neighbours(order, group)
        if s.verified(order, common):
            return order, common
    raise RuntimeError("hash collisions with 16 seeds")


def repeated(texts: list[bytes], off: np.ndarray, n: np.ndarray, group: np.ndarray, length: int):
    """For each context a mask of its windows: which are in another context of its group, too.

    Groups stand together.  Also the class of each window: equal windows of a group have equal numbers.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(texts), np.uint8)
    right, far = _ranked(buf, begin + off, sizes - off, group)
    flipped = np.frombuffer(b"".join(t[o - 1 :: -1] if o else b"" for t, o in zip(texts, off.tolist())), np.uint8)
    flipped = flipped if len(flipped) else np.zeros(1, np.uint8)
    left, near = _ranked(flipped, np.cumsum(off) - off, off.astype(np.int64), group)
    masks = [np.zeros(k, bool) for k in n.tolist()]
    ids = [np.zeros(k, np.int64) for k in n.tolist()]
    fresh_group = np.ones(len(group), bool)
    fresh_group[1:] = group[1:] != group[:-1]
    by_right, by_left = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for reach in range(int(off.max(initial=-1)) + 1):  # bytes that a window has before the anchor
        own = np.flatnonzero((off - n < reach) & (reach <= off))
        by_right[right] = np.cumsum(fresh_group | (far < length - reach))
        by_left[left] = np.cumsum(fresh_group | (near < reach))
        pair = by_right[own] * (len(group) + 1) + by_left[own]
        _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        for i, twice, k in zip(own.tolist(), (count[which] > 1).tolist(), which.tolist()):
            masks[i][off[i] - reach] = twice
            ids[i][off[i] - reach] = k
    return masks, ids


def _spans(mask: np.ndarray) -> list[dict]:
    """Runs of true as (a, b), b inclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"a": a, "b": b - 1} for a, b in edge.reshape(-1, 2).tolist()]


SORTED = "h long, c long, spans array<struct<a:int,b:int>>, w1 long, w2 long, place int"


def _sorter(length: int):
    """mapInArrow over (h, salt, salts, c, off, n, ctx), sorted by h and salt within the partitions."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        key = np.array([r[:2] for r in rows], np.int64)
        new = np.ones(len(rows), bool)
        new[1:] = (key[1:] != key[:-1]).any(axis=1)
        texts = [r[6] for r in rows]
        off, n = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        masks, ids = repeated(texts, off, n, np.cumsum(new), length)
        out = [(r[0], r[3], _spans(m), None, None, None) for r, m in zip(rows, masks)]
        seen: set = set()
        for r, own in zip(rows, ids):
            if r[2] > 1:  # other pieces of this anchor have to know each window once
                buf = np.frombuffer(r[6], np.uint8)
                at = np.arange(len(own))
                w = [Prefix(buf, base, 9).of(at, length).view(np.int64) for base in _BASES]
                for k, (x, y) in enumerate(zip(*(v.tolist() for v in w))):
                    name = (r[0], r[1], x, y)
                    if name not in seen:
                        seen.add(name)
                        out.append((r[0], r[3], None, x, y, k))
        span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), span, pa.int64(), pa.int64(), pa.int32()]
        arrays = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["h", "c", "spans", "w1", "w2", "place"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(rows) >= PIECE_CONTEXTS and row[:2] != rows[-1][:2]:
                    yield flush(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield flush(rows)

    return run


# --- over tables --------------------------------------------------------------------------------------------


def _with_text(keys: DataFrame, docs: DataFrame) -> DataFrame:
    """``keys`` (id, print, …) with the texts; documents that can't be among them are left out of the shuffle."""
    keys = saved(keys, "keys")
    wanted = keys.select(F.col("print").alias("h")).distinct()
    passes = bit_table(wanted, wanted.count())
    some = docs.where(passes(F.col("print"))).dropDuplicates(["id", "print"])
    same = keys["id"].eqNullSafe(some["id"]) & (keys["print"] == some["print"])
    return keys.join(some, same).select(keys["*"], some["text"])


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE_CONTEXTS
) -> DataFrame:
    """(id, print, spans) of the texts with bytes in a repeated string: sorted (a, b), b exclusive, apart.

    ``docs``: id, print (hash of the text), text without nulls.
    """
    field = T.StructField("runs", RUNS)
    found = map_texts(docs, "text", ["id", "print"], [field], lambda: lambda p: [_runs(p, length, gram)])
    runs = saved(found.select("id", "print", F.inline("runs")), "contexts")
    grams = runs.groupBy("h").agg(F.count("*").alias("times"), F.min("c").alias("one"), F.max("c").alias("other"))
    grams = grams.where("times > 1").select("h", (F.col("one") == F.col("other")).alias("alike"))
    grams = saved(grams, "grams")  # a join with a table, not with an aggregation, can split a frequent gram
    again = saved(runs.join(grams, "h"), "repeated")
    # contexts of grams that have several: one of each goes to the sort
    mixed = again.where(~F.col("alike"))
    first = F.min(F.struct("id", "print", "s", "off", "n")).alias("f")
    kinds = saved(mixed.groupBy("h", "c").agg(F.count("*").alias("times"), first), "kinds")
    cut = F.collect_list(F.struct("h", "c", "f.s", "f.off", "f.n")).alias("cuts")
    keys = kinds.groupBy(F.col("f.id").alias("id"), F.col("f.print").alias("print")).agg(cut)
    parts = _with_text(keys, docs).select(F.encode("text", "UTF-8").alias("raw"), F.inline("cuts"))
    ctx = F.expr(f"substring(raw, cast(s + 1 as int), n - 1 + {length})").alias("ctx")
    parts = parts.select("h", "c", "off", "n", ctx)
    many = saved(kinds.groupBy("h").agg(F.ceil(F.count("*") / piece).cast("int").alias("salts")), "salts")
    dealt = parts.join(many, "h").withColumn("salt", F.pmod("c", F.col("salts")))
    dealt = dealt.select("h", "salt", "salts", "c", "off", "n", "ctx").repartition("h", "salt")
    sorted_ = saved(dealt.sortWithinPartitions("h", "salt").mapInArrow(_sorter(length), SORTED), "sorted")
    # windows that pieces of one anchor have in common: each piece names a window once
    named = sorted_.where(F.col("place").isNotNull())
    shared = named.groupBy("h", "w1", "w2").agg(F.count("*").alias("k")).where("k > 1").select("h", "w1", "w2")
    span = lambda a, b: F.array(F.struct(a.alias("a"), b.alias("b"))).alias("spans")
    across = named.join(shared, ["h", "w1", "w2"]).select("h", "c", span(F.col("place"), F.col("place")))
    whole = kinds.where("times > 1").select("h", "c", span(F.lit(0), F.col("f.n") - 1))
    marks = sorted_.where(F.size("spans") > 0).select("h", "c", "spans").unionByName(across).unionByName(whole)
    marks = saved(marks.groupBy("h", "c").agg(F.flatten(F.collect_list("spans")).alias("spans")), "marks")
    hit = mixed.join(marks, ["h", "c"]).select("id", "print", "s", F.inline("spans"))
    hit = hit.selectExpr("id", "print", "s + a as a", f"s + b + {length} as b")
    sure = again.where("alike").selectExpr("id", "print", "s as a", f"s + n - 1 + {length} as b")
    sorted_spans = F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans")
    each = hit.unionByName(sure).groupBy("id", "print").agg(sorted_spans)
    joined = F.aggregate(
        F.slice("spans", 2, F.greatest(F.size("spans") - 1, F.lit(0))),
        F.slice("spans", 1, 1),
        lambda acc, s: F.when(
            s["a"] <= F.element_at(acc, -1)["b"],
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["a"].alias("a"),
                        F.greatest(F.element_at(acc, -1)["b"], s["b"]).alias("b"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    return each.select("id", "print", joined.alias("spans"))


def _kept(text: str | None, spans: list[dict]) -> bytes:
    data, out, at = (text or "").encode(), [], 0
    for s in spans:
        out.append(data[at : s["a"]])
        at = s["b"]
    return b"".join([*out, data[at:]])


def drop_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    piece: int = PIECE_CONTEXTS,
) -> DataFrame:
    """Every text without the bytes of strings of ``length`` bytes that also start anywhere else.

    Columns: key, n_bytes, ``removed`` (array of (a, b): byte spans, apart, sorted), ``kept`` (the bytes
    left, as binary: a cut may split a character).  Null counts as empty; texts below ``length`` bytes lose
    nothing; repeated rows repeat each other and lose all if long enough.
    """
    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("print", F.xxhash64("text"))
    spans = saved(repeated_spans(own, length, gram, piece), "spans")
    keys = spans.select(F.col("print").alias("h")).distinct()
    passes = bit_table(keys, keys.count())
    raw_text = F.encode("text", "UTF-8")
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    clean = own.where(~passes(F.col("print"))).select("id", n_bytes, none.alias("removed"), raw_text.alias("kept"))
    some = own.where(passes(F.col("print")))
    same = some["id"].eqNullSafe(spans["id"]) & (some["print"] == spans["print"])
    both = some.join(spans, same, "left").select(some["id"], "text", F.coalesce("spans", none).alias("removed"))

    def cut(batches):
        for batch in batches:
            texts, removed = batch.column("text").to_pylist(), batch.column("removed")
            kept = [_kept(t, s) for t, s in zip(texts, removed.to_pylist())]
            n = pa.array([len((t or "").encode()) for t in texts], pa.int64())
            arrays = [batch.column("id"), n, removed, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "removed", "kept"])

    done = both.mapInArrow(cut, clean.schema)
    return clean.unionByName(done).withColumnRenamed("id", key)


def repeat_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of what is left of every document; see ``op2_suffix_dedup``."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])
    return drop_repeats(docs).select(
        "doc_id",
        "n_bytes",
        n.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

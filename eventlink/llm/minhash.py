"""Near-duplicate documents by DartMinHash signatures.

A document is a weighted set: its shingles of ``SHINGLE`` words, weighed by how often they occur.  Darts fall on
the area over each unit of weight, at ranks that a hash of the unit fixes (a Poisson process), so equal units
of two documents get equal darts.  Only darts below a rank limit are thrown, about k ln k + 2k for a
document however long it is.  Each dart belongs to one of k coordinates; the earliest dart of a coordinate is
its entry in the signature, and two documents agree there with the probability of their weighted Jaccard
similarity.  A document with an empty coordinate is thrown again with twice the limit.

Documents with a band of the signature in common are compared exactly.  First each is compared with one other, a hub of
the largest bucket it is in; that joins most of what belongs together.  Then only pairs of different components
count: all of a small bucket, and of a large one its members with the one that meets most others, then block with
block.  Connected components of what is similar enough are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import fresh, map_texts, mix, raw, saved, tokens
from eventlink.llm.graph import components, merged

SHINGLE = 5
SIMILAR = 0.8
#: 25 bands of 4: a pair at the threshold shares none with a probability of 2e-6.
BANDS, BAND_SIZE = 25, 4
#: Hubs of a bucket, but the first: one with no more members besides is compared whole by them.
HUBS = 4
#: Units of a block of documents that are compared with another block; each document counts as EACH more.
BLOCK, EACH = 1 << 18, 256
#: Units that two blocks are compared by at a time.
WIDTH = 4096
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * _STEP) | np.uint64(1)


def units(words: np.ndarray, doc: np.ndarray, n: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every unit of weight: each shingle, told apart by how often it came before.

    A document of fewer words than a shingle is one shingle of all its words.
    """
    count = np.bincount(doc, minlength=n)
    hashes, owner = [], []
    m = len(words) - size + 1
    if m > 0:
        whole = doc[:m] == doc[size - 1 :]
        h = np.zeros(m, np.uint64)
        for j in range(size):
            h += words[j : m + j] * _SEEDS[j]
        hashes.append(mix(h[whole]))
        owner.append(doc[:m][whole])
    short = np.flatnonzero((count > 0) & (count < size))
    begin = np.cumsum(count) - count
    for d in short.tolist():
        own = words[begin[d] : begin[d] + count[d]]
        hashes.append(mix(np.array([(own * _SEEDS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))])))
        owner.append(np.array([d]))
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, d = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    begin = np.flatnonzero(first)
    nth = np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))
    again = nth > 0
    h[again] = mix(h[again] + nth[again].astype(np.uint64) * _STEP)
    return d, h


def signatures(doc: np.ndarray, unit: np.ndarray, n: int, k: int) -> np.ndarray:
    """k entries for each of n documents; zeros for a document without units."""
    out = np.zeros((n, k), np.uint64)
    weight = np.bincount(doc, minlength=n)
    limit = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    todo = np.flatnonzero(weight)
    place = np.full(n, -1)
    while len(todo):
        place[:] = -1
        place[todo] = np.arange(len(todo))
        own = place[doc] >= 0
        d, u = place[doc[own]], unit[own]
        most = limit[todo][d]
        rank, cells, ranks, darts, t = np.zeros(len(u)), [], [], [], 0
        while len(u):
            dart = mix(u + np.uint64((t + 1) * int(_STEP) & (1 << 64) - 1))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            hit = rank < most
            d, u, most, rank, dart = d[hit], u[hit], most[hit], rank[hit], mix(dart[hit] ^ _SEEDS[0])
            cells.append(d * k + (dart % np.uint64(k)).astype(np.int64))
            ranks.append(rank)
            darts.append(dart)
            t += 1
        cell, rank, dart = np.concatenate(cells), np.concatenate(ranks), np.concatenate(darts)
        order = np.lexsort((rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        flat = np.zeros(len(todo) * k, np.uint64)
        flat[cell[first]] = dart[first] | np.uint64(1)  # never 0, which stands for an empty coordinate
        flat = flat.reshape(len(todo), k)
        out[todo] = flat
        todo = todo[(flat == 0).any(axis=1)]
        limit[todo] *= 2
    return out


def _documents(part: pa.Array):
    buf, offsets = raw(part)
    _, _, h, doc = tokens(buf, offsets)
    return h, doc, len(part)


def _norms(h: np.ndarray, doc: np.ndarray, n: int) -> list[bytes | None]:
    """128 bits of each document's sequence of words; None without words."""
    count = np.bincount(doc, minlength=n)
    begin = np.cumsum(count) - count
    at = (np.arange(len(h)) - np.repeat(begin, count)).astype(np.uint64)
    full = np.flatnonzero(count)
    sums = [
        mix(np.add.reduceat(mix(h * seed + at * _STEP), begin[full]) + count[full].astype(np.uint64))
        if len(full)
        else np.empty(0, np.uint64)
        for seed in _SEEDS[-2:]
    ]
    out: list[bytes | None] = [None] * n
    pairs = np.column_stack(sums).astype("<u8")
    for d, pair in zip(full.tolist(), pairs):
        out[d] = pair.tobytes()
    return out


def signed(docs: DataFrame, text: str, keep: list[str], bands: int = BANDS, size: int = BAND_SIZE) -> DataFrame:
    """``keep``, ``norm`` (128 bits of the words' sequence) and ``bands`` of whole texts; null without words."""

    def make():
        def work(part):
            h, doc, n = _documents(part)
            norms = _norms(h, doc, n)
            d, u = units(h, doc, n)
            sig = signatures(d, u, n, bands * size).reshape(n, bands, size)
            band = np.zeros((n, bands), np.uint64)
            for j in range(size):
                band += sig[:, :, j] * _SEEDS[j]
            band = mix(band + np.arange(1, bands + 1, dtype=np.uint64) * _STEP).view(np.int64)
            return [
                pa.array(norms, pa.binary()),
                pa.array([b if x is not None else None for b, x in zip(band, norms)], pa.list_(pa.int64())),
            ]

        return work

    fields = [T.StructField("norm", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    return map_texts(docs, text, keep, fields, make)


def _with_units(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    def make():
        def work(part):
            h, doc, n = _documents(part)
            d, u = units(h, doc, n)
            at = np.searchsorted(d, np.arange(n + 1))
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(u.view(np.int64)))]

        return work

    return map_texts(docs, text, keep, [T.StructField("units", T.ArrayType(T.LongType()))], make)


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity, computed exactly, is ``least`` or more."""
    x = sets.select(F.col("norm").alias("a"), F.col("units").alias("ua"))
    y = sets.select(F.col("norm").alias("b"), F.col("units").alias("ub"))
    n = F.size(F.array_intersect("ua", "ub"))
    both = pairs.join(x, "a").join(y, "b")
    return both.where(n >= least * (F.size("ua") + F.size("ub") - n)).select("a", "b")


def similar_across(left: np.ndarray, right: np.ndarray, label, sizes, unit, least: float) -> list[tuple[int, int]]:
    """Pairs of a document of ``left`` and one of ``right`` that are similar and of different labels.

    The two are the same places or have none in common; ``unit`` holds the units of all documents end to end.
    Of the pairs those stay that join what no earlier pair has joined.
    """
    unit = np.unique(unit, return_inverse=True)[1].reshape(-1)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n = int(unit.max()) + 1 if len(unit) else 0
    row = [np.full(len(sizes), -1), np.full(len(sizes), -1)]
    row[0][left], row[1][right] = np.arange(len(left)), np.arange(len(right))
    own = [r[doc] >= 0 for r in row]
    both = (np.bincount(unit[own[0]], minlength=n) > 0) & (np.bincount(unit[own[1]], minlength=n) > 0)
    column = np.cumsum(both) - 1
    sides = []
    for r, mine in zip(row, own):
        u, d = unit[mine & both[unit]], r[doc[mine & both[unit]]]
        order = np.argsort(column[u], kind="stable")
        sides.append((column[u][order], d[order]))
    shared = np.zeros((len(left), len(right)))
    for a in range(0, int(both.sum()), WIDTH):
        parts = []
        for (col, d), k in zip(sides, shared.shape):
            i, j = np.searchsorted(col, [a, a + WIDTH])
            part = np.zeros((k, WIDTH), np.float32)
            part[d[i:j], col[i:j] - a] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    near = shared >= least * (sizes[left][:, None] + sizes[right][None, :] - shared)
    near &= label[left][:, None] != label[right][None, :]
    up = np.arange(int(label.max()) + 1 if len(label) else 0).tolist()
    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
        a, b = int(label[left[i]]), int(label[right[j]])
        while up[a] != a:
            up[a] = a = up[up[a]]
        while up[b] != b:
            up[b] = b = up[up[b]]
        if a != b:
            up[max(a, b)] = min(a, b)
            found.append((int(left[i]), int(right[j])))
    return found


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _first_pairs(shared: DataFrame) -> DataFrame:
    """For each document its pair (a, b) with the first hub of the largest of its buckets."""
    hub = F.max_by("h0", F.struct("n", "band")).alias("hub")
    return shared.where("norm <> h0").groupBy("norm").agg(hub).select(*_pair("norm", "hub")).distinct()


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are of different components."""
    la, lb = (label.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    both = pairs.join(la, "a", "left").join(lb, "b", "left")
    return both.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def _open(members: DataFrame, label: DataFrame) -> DataFrame:
    """band, norm, label, n: ``members`` (band, norm) of the buckets that hold several components; n is their size."""
    members = members.join(label, F.col("norm") == F.col("node"), "left")
    members = saved(members.select("band", "norm", F.coalesce("label", "norm").alias("label")), "members")
    several = members.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("l"), F.max("label").alias("m"))
    return saved(members.join(saved(several.where("l <> m").select("band", "n"), "several"), "band"), "open")


def _popular(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's member that meets most others in all its buckets, and those of other components.

    The original of many copies is such a member, so few blocks are left after it.
    """
    meets = members.groupBy("norm").agg(F.sum("n").alias("meets"))
    most = F.max(F.struct("meets", "norm", "label")).alias("most")
    hubs = members.join(meets, "norm").groupBy("band").agg(most)
    hubs = saved(hubs.select("band", F.col("most.norm").alias("hub"), F.col("most.label").alias("hub_label")), "hubs")
    pairs = members.join(hubs, "band").where("label <> hub_label")
    return pairs.select(*_pair("norm", "hub")).distinct()


def _across(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Similar pairs (a, b) out of all members of a bucket that are of different components.

    A component of a bucket that is large enough has blocks of its own, which are not compared with one another;
    the small ones share blocks.
    """
    members = saved(members.join(sets.select("norm", "n_units"), "norm"), "weighed")
    weight = F.sum(F.col("n_units") + EACH)
    parts = members.groupBy("band", "label").agg(weight.alias("w"))
    large = F.col("w") > BLOCK // 2
    small = parts.where(~large).groupBy("band").agg(F.ceil(F.sum("w") / BLOCK).alias("k"))
    large = saved(parts.where(large).select("band", "label", F.ceil(F.col("w") / BLOCK).alias("own")), "large")
    dealt = members.join(large, ["band", "label"], "left").join(saved(small, "small"), "band", "left")
    alone = F.col("own").isNotNull()
    of = F.when(alone, F.col("label")).otherwise(F.lit(b""))
    part = F.when(alone, F.pmod(F.xxhash64("norm"), "own")).otherwise(F.pmod(F.xxhash64("label"), "k"))
    dealt = saved(dealt.select("band", "norm", "label", F.struct(of.alias("of"), part.alias("part")).alias("block")), "dealt")
    blocks = saved(dealt.select("band", "block").distinct(), "blocks")
    x, y = blocks.withColumnRenamed("block", "x"), blocks.withColumnRenamed("block", "y")
    pairs = saved(x.join(y, "band").where("x <= y and (x.of <> y.of or octet_length(x.of) = 0)"), "block-pairs")
    first = pairs.select("*", F.col("x").alias("block"), F.lit(True).alias("left"))
    second = pairs.where("x <> y").select("*", F.col("y").alias("block"), F.lit(False).alias("left"))
    sent = dealt.join(first.unionByName(second), ["band", "block"]).join(sets.select("norm", "units"), "norm")
    sent = sent.select("band", "x", "y", "left", "norm", "label", "units")

    def compare(group: pa.Table) -> pa.Table:
        norms, sets_ = group["norm"].combine_chunks(), group["units"].combine_chunks()
        label = group["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.array(group["left"].to_pylist(), bool)
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        sizes, unit = sets_.value_lengths().to_numpy(), sets_.flatten().to_numpy()
        found = similar_across(left, right if len(right) else left, label, sizes.astype(np.int64), unit, least)
        ends = [norms.take(pa.array([p[k] for p in found], pa.int64())) for k in (0, 1)]
        return pa.table(ends, names=["a", "b"])

    return sent.groupBy("band", "x", "y").applyInArrow(compare, "a binary, b binary")


def _print(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", similar: float = SIMILAR):
    """(members, firsts): the class of every row, and of every class the row that stands for it.

    members: key, ``print`` (hash of the text), ``class_key``: the smallest key of the class.  firsts:
    key, print, rows (how many rows have just these).
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), _print(text).alias("print"))
    rows = saved(signed(own, "text", ["key", "print"]), "signed")
    worded = rows.where(F.col("norm").isNotNull())
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "print")).alias("first")
    reps = saved(worded.groupBy("norm").agg(first, F.any_value("bands").alias("bands")), "representatives")
    each = reps.select("norm", F.explode("bands").alias("band"))
    order = lambda j: F.struct(F.xxhash64("norm", "band", F.lit(j)), "norm")
    hub = [F.min(order(j))["norm"].alias(f"h{j}") for j in range(HUBS + 1)]
    # a join with a table, not with an aggregation, can split a crowded bucket
    buckets = each.groupBy("band").agg(F.count("*").alias("n"), *hub).where("n > 1")
    # where all of a bucket's members but one are hubs, comparing with hubs compares all of it
    tried = F.size(F.array_distinct(F.array(*[f"h{j}" for j in range(HUBS + 1)])))
    buckets = saved(buckets.withColumn("whole", tried >= F.col("n") - 1), "buckets")
    shared = saved(each.join(buckets.select("band", "n", "h0", "whole"), "band"), "shared")
    seen = shared.select("norm").distinct()
    texts = reps.join(seen, "norm").select("norm", "first.key", "first.print")
    texts = texts.withColumnRenamed("key", "k").withColumnRenamed("print", "p")
    same = own["key"].eqNullSafe(texts["k"]) & (own["print"] == texts["p"])
    texts = own.join(texts, same).select("norm", "text")
    sets = _with_units(texts, "text", ["norm"]).dropDuplicates(["norm"]).withColumn("n_units", F.size("units"))
    sets = saved(sets, "units")
    # one pair for each document connects most of what is similar; others matter only where they join two components
    label = components(saved(_similar(_first_pairs(shared), sets, similar), "similar"))
    hubs = F.array(*[F.struct(F.col(f"h{j}").alias("hub")) for j in range(HUBS + 1)])
    few = shared.where("whole").select("band", "norm").join(buckets.select("band", hubs.alias("hubs")), "band")
    few = few.select("norm", F.inline("hubs")).where("norm <> hub").select(*_pair("norm", "hub")).distinct()
    label = merged(label, saved(_similar(_apart(few, label), sets, similar), "similar"))
    rest = shared.where("not whole")
    changed = True
    for find in (lambda m: _similar(_popular(m), sets, similar), lambda m: _across(m, sets, similar)):
        rest = _open(rest.select("band", "norm"), label) if changed else rest
        if not rest.limit(1).count():
            break
        more = saved(find(rest), "similar")
        changed = more.limit(1).count() > 0
        if changed:
            label = merged(label, more)
    named = reps.select("norm", "first").join(label, F.col("norm") == F.col("node"), "left")
    named = named.select("norm", "first", F.coalesce("label", "norm").alias("label"))
    heads = saved(named.groupBy("label").agg(F.min("first").alias("head")), "heads")
    head_of = named.join(heads, "label").select("norm", F.col("head.key").alias("class_key"))
    members = worded.select("key", "print", "norm").join(head_of, "norm").select("key", "print", "class_key")
    bare = rows.where(F.col("norm").isNull()).select("key", "print", F.col("key").alias("class_key"))
    firsts = heads.select("head.key", "head.print")
    return members.unionByName(bare), firsts, rows


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similar: float = SIMILAR
) -> DataFrame:
    """``key`` and ``class_id`` (the smallest key of its class) of every row.

    Rows are of a class if a chain of pairs at least ``similar`` connects them.  Texts of equal words are
    always of one class.  Null, empty and wordless texts are classes of their own.  Repeated rows are
    members each.  A null key stands for a class only if the class has no other.
    """
    members, _, _ = classes(docs, text, key, similar)
    return members.select(F.col("key").alias(key), F.col("class_key").alias("class_id"))


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similar: float = SIMILAR
) -> DataFrame:
    """One row of each class, that of the smallest key, columns as they are; wordless texts all stay."""
    _, firsts, rows = classes(docs, text, key, similar)
    bare = rows.where(F.col("norm").isNull()).select("key", "print").distinct()
    stay = firsts.unionByName(bare).select(F.col("key").alias("_k"), F.col("print").alias("_p"))
    name = fresh(docs, "_print")
    own = docs.withColumn(name, _print(text))
    kept = own.join(stay, own[key].eqNullSafe(stay["_k"]) & (own[name] == stay["_p"]), "left_semi")
    keyed = rows.where(F.col("norm").isNotNull()).groupBy("key", "print").count()
    if keyed.where("count > 1").limit(1).count():  # the same key and text in several rows: one of them stays
        wordless = F.regexp_count(F.col(text), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")) == 0
        wordless = F.coalesce(wordless, F.lit(True))
        kept = kept.where(~wordless).dropDuplicates([key, name]).unionByName(kept.where(wordless))
    return kept.select(*docs.columns)

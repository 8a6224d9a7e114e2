"""Log probabilities of texts by a Katz backoff bigram model learnt from the same table.

Counts are discounted by Good-Turing.  A pair that training has seen has its discounted share of its
history's count; an unseen one gets the history's backoff weight times the unigram probability, and an
unseen word the unigrams' left-over.  The weights are the left-over mass of a history divided by that of its
unseen words' unigrams, so that every history's probabilities sum to 1.

How it is laid out.  Texts become blocks of token ids once.  Words are counted in buckets of their hash and
numbered by falling count, so a number tells the count.  Every pair (history, word) of every text goes once to
the bucket of its history; histories that are frequent enough to overload a bucket are dealt over several by
the word.  A bucket counts its training pairs, which are stored as the model's table, and looks up all pairs;
what depends on the global counts of counts is kept as numbers by text until those are known.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from eventlink.llm.common import SOLID_BYTE, crc_mod, maybe_broadcast, mix, pieces, raw, saved, texts_of, tokens

#: Bytes of text in a block, tokens counted in a bucket.
BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 2_000_000
#: Counts up to this are discounted.
LOW = 5
#: A small share of each history's count is kept back, so that none is closed to unseen words.
RESERVE = 0.01
UNKNOWN = 0xFFFFFFFF
_END = np.uint64(0x5851F42D4C957F2D)
#: Rows of the table of first numbers by bucket and count that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def pack(a: np.ndarray) -> bytes:
    data = np.ascontiguousarray(a).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes, kind) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], n, codec="zstd", asbytes=True), kind)


# --- discounts ------------------------------------------------------------------------------------------------


def _katz(n: np.ndarray) -> np.ndarray | None:
    """d[1..LOW] from counts of counts n[1..LOW + 1]; None unless all lie between 0 and 1."""
    r = np.arange(1, LOW + 1)
    top = (LOW + 1) * n[LOW + 1] / n[1]
    if top >= 1:
        return None
    d = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top)
    return np.append(1.0, d) if ((d > 0) & (d < 1)).all() else None


def discounts(of: list[int]) -> np.ndarray:
    """Good-Turing discounts by Katz, d[1..LOW] (d[0] unused); ``of[r]``: things seen r + 1 times, r = 0..LOW.

    Copied texts can make the counts of counts uneven, so that a discount is not between 0 and 1.  Then they
    are smoothed by a straight line through their logarithms, and if that does not help (hardly any data)
    half a count is taken off.
    """
    n = np.array([0, *of[: LOW + 1]], float)
    r = np.arange(1, LOW + 2)
    found = _katz(n) if (n[1:] > 0).all() else None
    some = n[1:] > 0
    if found is None and some.sum() > 1:
        slope, level = np.polyfit(np.log(r[some]), np.log(n[1:][some]), 1)
        found = _katz(np.append(0, np.exp(level + slope * np.log(r))))
    return np.append(1.0, (r[:LOW] - 0.5) / r[:LOW]) if found is None else found


@dataclass
class Unigrams:
    """Words are numbered by falling count: class k has count ``counts[k]`` and numbers from ``first[k]`` on."""

    counts: np.ndarray
    first: np.ndarray
    words: int  # V
    total: int  # N
    texts: int  # of the training

    def __post_init__(self):
        sizes = np.diff(np.append(self.first, self.words))
        by = dict(zip(self.counts.tolist(), sizes.tolist()))
        d = discounts([by.get(r, 0) for r in range(1, LOW + 2)])
        share = self.counts * np.where(self.counts <= LOW, d[np.minimum(self.counts, LOW)], 1.0)
        self.p = share / (self.total + RESERVE)
        self.rest = (RESERVE + ((self.counts - share) * sizes).sum()) / (self.total + RESERVE)
        self.log_p = np.log10(np.append(self.p, self.rest))
        self.base = np.log10((np.append(self.counts, 0) + 0.5) / (self.total + 0.5 * (self.words + 1)))

    @property
    def begin(self) -> int:
        """The number of the history before a text's first word."""
        return self.words

    def of(self, ids: np.ndarray) -> np.ndarray:
        """Class of each number; that of unknown words is the last."""
        k = np.searchsorted(self.first, ids, side="right") - 1
        return np.where(ids >= self.words, len(self.counts), k)

    def count(self, ids: np.ndarray) -> np.ndarray:
        """How often training has each as a history (or token)."""
        return np.where(ids == self.begin, self.texts, np.append(self.counts, 0)[self.of(ids)])


# --- blocks of tokens --------------------------------------------------------------------------------------------


def _sequence(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with one end for each text, tokens of each text)."""
    buf, offsets = raw(part)
    _, _, h, doc = tokens(buf, offsets, SOLID_BYTE)
    size = np.bincount(doc, minlength=len(part)) + 1
    out = np.empty(len(h) + len(part), np.uint64)
    out[np.arange(len(h)) + doc] = h
    out[np.cumsum(size) - 1] = _END
    return out, size


BLOCK = (
    "block long, keys array<{key}>, n_tokens long, sizes binary, train binary, toks binary, words binary, "
    "lanes binary, counts binary"
)


def _blocks(batches):
    """Rows of (key, train, text) as blocks: local token numbers, their hashes, their counts in training."""
    task, number = TaskContext.get().partitionId(), 0
    names = ["block", "keys", "n_tokens", "sizes", "train", "toks", "words", "lanes", "counts"]

    def flush(keys, train, seqs, sizes):
        tok, size = np.concatenate(seqs), np.concatenate(sizes)
        words, own, n = np.unique(tok, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        own = place[own]
        flags = np.concatenate(train)
        counts = np.bincount(own[np.repeat(flags, size)], minlength=len(words))
        words, size = words[order], size.astype(np.int32)
        values = [pack(x) for x in (size, flags, own, words, lanes_of(words), counts.astype(np.int32))]
        keys = pa.concat_arrays(keys)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) + number]),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                pa.array([len(tok)]),
                *[pa.array([v], pa.binary()) for v in values],
            ],
            names=names,
        )

    held: list[list] = [[], [], [], []]
    room = 0
    for batch in batches:
        at = 0
        for part in pieces(texts_of(batch.column("text"))):
            seq, size = _sequence(part)
            own = slice(at, at + len(part))
            at += len(part)
            held[0].append(batch.column("key")[own])
            held[1].append(batch.column("train")[own].to_numpy(zero_copy_only=False).astype(bool))
            held[2].append(seq)
            held[3].append(size)
            room += len(raw(part)[0]) + len(part)
            if room >= BLOCK_BYTES:
                yield flush(*held)
                held, room, number = [[], [], [], []], 0, number + 1
    if held[0]:
        yield flush(*held)


# --- unigrams ------------------------------------------------------------------------------------------------------


#: Words are counted in at most so many buckets.
LANES = 1 << 16


def lanes_of(words: np.ndarray) -> np.ndarray:
    """The two bytes of a word's hash that tell its bucket: all that the pairs need of it later."""
    return (words >> np.uint64(48)).astype(np.uint16)


def _listed_words(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = unpack(row["words"], np.uint64), unpack(row["counts"], np.int32)
                bucket = lanes_of(words).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in range(buckets):
                    own = order[cut[b] : cut[b + 1]]
                    if len(own):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([b]),
                                pa.array([row["block"]]),
                                pa.array([pack(words[own])], pa.binary()),
                                pa.array([pack(counts[own])], pa.binary()),
                            ],
                            names=["bucket", "block", "words", "counts"],
                        )

    return run


def _counted(table: pa.Table) -> pa.Table:
    """Counts of a bucket's words; ``maps``: for each block the places of its words by falling count."""
    rows = table.to_pylist()
    words = [unpack(r["words"], np.uint64) for r in rows]
    size = np.array([len(w) for w in words])
    own, which = np.unique(np.concatenate(words), return_inverse=True)
    c = np.bincount(which, np.concatenate([unpack(r["counts"], np.int32) for r in rows]), len(own)).astype(np.int64)
    order = np.argsort(-c, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    maps = np.split(place[which], np.cumsum(size)[:-1])
    value, n = np.unique(c[c > 0], return_counts=True)
    classes = [{"c": x, "size": y} for x, y in zip(value.tolist()[::-1], n.tolist()[::-1])]
    kind = pa.list_(pa.struct([("c", pa.int64()), ("size", pa.int64())]))
    return pa.Table.from_arrays(
        [
            pa.array([rows[0]["bucket"]]),
            pa.array([[r["block"] for r in rows]], pa.list_(pa.int64())),
            pa.array([[pack(m) for m in maps]], pa.list_(pa.binary())),
            pa.array([pack(own[order][: int(n.sum())])], pa.binary()),
            pa.array([classes], kind),
        ],
        names=["bucket", "blocks", "maps", "words", "classes"],
    )


def _numbered(batches):
    """The numbers of each block's words of a bucket, in the block's order."""
    for batch in batches:
        for row in batch.to_pylist():
            size = np.array([k["size"] for k in row["classes"]], np.int64)
            begin = np.cumsum(size) - size
            first = np.array(row["firsts"] or [], np.int64)
            known = int(size.sum())
            number = np.full(known + 1, UNKNOWN, np.uint32)
            number[:known] = np.arange(known) + np.repeat(first - begin, size)
            for block, places in zip(row["blocks"], row["maps"]):
                ids = number[np.minimum(unpack(places, np.uint32), known)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([row["bucket"]]), pa.array([pack(ids)], pa.binary())],
                    names=["block", "bucket", "ids"],
                )


# --- pairs -----------------------------------------------------------------------------------------------------------

PAIRS = "bucket long, block long, train binary, hs binary, runs binary, w binary, d binary, keys array<{key}>, facts binary"


def _spread(uni: Unigrams, h: np.ndarray, buckets: int) -> np.ndarray:
    """Over how many buckets the pairs of a history are dealt, by its share of all tokens."""
    return np.maximum(1, -(-uni.count(h) * 4 * buckets // max(uni.total, 1))).astype(np.int64)


def _pair_rows(uni: Unigrams, word_buckets: int, buckets: int, keys: pa.DataType):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from block(row)

    def block(row):
        lanes, own = unpack(row["lanes"], np.uint16), unpack(row["toks"], np.uint32)
        size, train = unpack(row["sizes"], np.int32).astype(np.int64), unpack(row["train"], bool)
        bucket = lanes.astype(np.int64) % word_buckets
        number = np.empty(len(lanes), np.uint32)
        for part in row["numbers"]:
            number[bucket == part["bucket"]] = unpack(part["ids"], np.uint32)
        cls = uni.of(number.astype(np.int64))
        begin = np.cumsum(size) - size
        doc = np.repeat(np.arange(len(size)), size)
        w = number[own].astype(np.int64)
        h = np.empty_like(w)
        h[1:] = w[:-1]
        h[begin] = uni.begin
        lost = h == UNKNOWN  # an unknown history: the unigram alone
        local = np.bincount(doc[lost], uni.log_p[cls[own[lost]]], len(size))
        known = np.bincount(doc[w != UNKNOWN], minlength=len(size))
        base = np.bincount(doc, uni.base[cls[own]], len(size))
        facts = np.column_stack([size, known, base, local]).astype(np.float64)
        keep = np.flatnonzero(~lost)
        h, w, doc = h[keep], w[keep], doc[keep]
        lane = (mix(w.astype(np.uint64)) % _spread(uni, h, buckets).astype(np.uint64)).astype(np.int64)
        to = ((mix(h.astype(np.uint64) + np.uint64(1)) >> np.uint64(8)).astype(np.int64) + lane) % buckets
        order = np.argsort((h << 32) | w, kind="stable")
        order = order[np.argsort(to[order].astype(np.uint16 if buckets < 1 << 16 else np.int64), kind="stable")]
        h, w, doc, to = h[order], w[order], doc[order], to[order]
        cut = np.searchsorted(to, np.arange(buckets + 1))
        home = row["block"] % buckets
        for b in range(buckets):
            x, y, z = (v[cut[b] : cut[b + 1]] for v in (h, w, doc))
            if not len(x) and b != home:
                continue
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
            runs = np.diff(np.append(first, len(x)))
            values = [np.packbits(train), x[first].astype(np.uint32), runs.astype(np.uint32), y.astype(np.uint32), z.astype(np.uint32)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b]),
                    pa.array([row["block"]]),
                    *[pa.array([pack(v)], pa.binary()) for v in values],
                    pa.array([row["keys"] if b == home else None], keys),
                    pa.array([pack(facts) if b == home else None], pa.binary()),
                ],
                names=["bucket", "block", "train", "hs", "runs", "w", "d", "keys", "facts"],
            )

    return run


STATS = (
    "bucket long, of array<long>, pairs binary, times binary, hot array<struct<h:long,low:array<long>,mass:double>>, "
    "hs binary, low binary, mass binary, parts array<struct<block:long,docs:int,part:binary,low:binary,open_h:binary,open_d:binary>>, "
    "homes array<struct<block:long,keys:array<{key}>,facts:binary>>"
)


def _stats_type(key: pa.DataType) -> pa.Schema:
    hot = pa.struct([("h", pa.int64()), ("low", pa.list_(pa.int64())), ("mass", pa.float64())])
    part = pa.struct(
        [("block", pa.int64()), ("docs", pa.int32())] + [(n, pa.binary()) for n in ("part", "low", "open_h", "open_d")]
    )
    home = pa.struct([("block", pa.int64()), ("keys", pa.list_(key)), ("facts", pa.binary())])
    return pa.schema(
        [("bucket", pa.int64()), ("of", pa.list_(pa.int64())), ("pairs", pa.binary()), ("times", pa.binary())]
        + [("hot", pa.list_(hot)), ("hs", pa.binary()), ("low", pa.binary()), ("mass", pa.binary())]
        + [("parts", pa.list_(part)), ("homes", pa.list_(home))]
    )


def _bucket_stats(uni: Unigrams, buckets: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, docs, flags = [], [], []
        for r in rows:
            h, w = unpack(r["hs"], np.uint32).astype(np.int64), unpack(r["w"], np.uint32).astype(np.int64)
            keys.append((np.repeat(h, unpack(r["runs"], np.uint32)) << 32) | w)
            docs.append(unpack(r["d"], np.uint32).astype(np.int64))
            flags.append(np.unpackbits(unpack(r["train"], np.uint8)).astype(bool))
        pairs, times = np.unique(np.concatenate([k[f[d]] for k, d, f in zip(keys, docs, flags)]), return_counts=True)
        low = times <= LOW
        hs, of_h = np.unique(pairs >> 32, return_inverse=True)
        table_low = np.zeros((len(hs), LOW), np.int64)
        np.add.at(table_low, (of_h[low], times[low] - 1), 1)
        p1 = np.append(uni.p, uni.rest)[uni.of(pairs & UNKNOWN)]
        mass = np.bincount(of_h, p1, len(hs))
        hot = _spread(uni, hs, buckets) > 1
        parts, asked = [], []
        for r, k, d, f in zip(rows, keys, docs, flags):
            n = int(d.max(initial=-1)) + 1
            at = np.minimum(np.searchsorted(pairs, k), max(len(pairs) - 1, 0))
            seen = pairs[at] == k if len(pairs) else np.zeros(len(k), bool)
            c = np.where(seen, times[at] if len(pairs) else 0, 1)
            h, w = k >> 32, k & UNKNOWN
            log = np.where(seen, np.log10(c) - np.log10(uni.count(h) + RESERVE), uni.log_p[uni.of(w)])
            few = seen & (c <= LOW)
            by = np.bincount(d[few] * LOW + c[few] - 1, minlength=n * LOW)
            asked.append(np.unique(h[~seen]))
            parts.append(
                {
                    "block": r["block"],
                    "docs": n,
                    "part": pack(np.bincount(d, log, n)),
                    "low": pack(by.astype(np.uint32)),
                    "open_h": pack(h[~seen].astype(np.uint32)),
                    "open_d": pack(d[~seen].astype(np.uint32)),
                }
            )
        need = np.isin(hs, np.concatenate(asked)) & ~hot
        hots = [{"h": h, "low": x, "mass": m} for h, x, m in zip(hs[hot].tolist(), table_low[hot].tolist(), mass[hot].tolist())]
        homes = [{"block": r["block"], "keys": r["keys"], "facts": r["facts"]} for r in rows if r["facts"] is not None]
        values = {
            "bucket": [rows[0]["bucket"]],
            "of": [[int((times == i).sum()) for i in range(1, LOW + 2)]],
            "pairs": [pack(pairs)],
            "times": [pack(times.astype(np.uint32))],
            "hot": [hots],
            "hs": [pack(hs[need].astype(np.uint32))],
            "low": [pack(table_low[need])],
            "mass": [pack(mass[need])],
            "parts": [parts],
            "homes": [homes],
        }
        return pa.Table.from_pydict(values, schema=schema)

    return run


def _backoff(uni: Unigrams, d: np.ndarray, hs: np.ndarray, low: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """log10 of the backoff weights: left-over of the pairs over that of the unigrams."""
    r = np.arange(1, LOW + 1)
    left = (RESERVE + (low * (r * (1 - d[1:]))).sum(axis=1)) / (uni.count(hs) + RESERVE)
    return np.log10(left) - np.log10(np.maximum(1 - mass, 1e-300))


def _final_parts(uni: Unigrams, d: np.ndarray, hot: dict):
    log_d = np.log10(d[1:])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hs = unpack(row["hs"], np.uint32).astype(np.int64)
                low = unpack(row["low"], np.int64).reshape(-1, LOW)
                weight = _backoff(uni, d, hs, low, unpack(row["mass"], np.float64))
                hs = np.concatenate([hs, hot["h"], [1 << 40]])
                weight = np.concatenate([weight, hot["log"], [0.0]])
                order = np.argsort(hs)
                hs, weight = hs[order], weight[order]
                for p in row["parts"]:
                    n = p["docs"]
                    h, doc = unpack(p["open_h"], np.uint32).astype(np.int64), unpack(p["open_d"], np.uint32)
                    at = np.searchsorted(hs, h)
                    fits = hs[at] == h  # a history without a training pair here has weight 1
                    by = unpack(p["low"], np.uint32).reshape(n, LOW)
                    part = unpack(p["part"], np.float64) + by @ log_d
                    part += np.bincount(doc, np.where(fits, weight[at], 0.0), n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p["block"]]), pa.array([part.tobytes()], pa.binary())], names=["block", "part"]
                    )

    return run


def _block_scores(keys: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.float64) for p in table["part"].to_pylist() if p is not None]
        names = next(k for k in table["keys"].to_pylist() if k is not None)
        facts = np.array(unpack(next(f for f in table["facts"].to_pylist() if f is not None), np.float64).reshape(-1, 4))
        for p in sorted(parts, key=lambda p: (len(p), p.tobytes())):  # one order of summing, however rows arrive
            facts[: len(p), 3] += p
        whole = [pa.array(facts[:, i].astype(np.int64)) for i in (0, 1)]
        return pa.Table.from_arrays(
            [pa.array(names, keys.value_type), *whole, pa.array(facts[:, 2]), pa.array(facts[:, 3])],
            names=["key", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


# --- the whole ----------------------------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """log10 probability of every whole text under the model of the rows for which ``train`` holds.

    Columns: key, n_tokens, n_known (tokens that training has), train_tokens, base_score (unigrams with half
    a count added), score (the Katz model).  A text is its words, A-Z in lower case, and one end; null counts
    as empty, which is just the end.  Repeated rows are scored, and learnt from, each.  Without training
    rows every token is unknown and certain (score 0).  Up to 2**32 - 2 different words can be numbered.
    """
    kind = docs.schema[key].dataType
    name = kind.simpleString()
    arrow = pa.list_(to_arrow_type(kind))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    blocks = saved(rows.mapInArrow(_blocks, BLOCK.format(key=name)), "token-blocks")
    facts = blocks.agg(F.sum("n_tokens").alias("n"), F.count("*").alias("blocks")).head()
    buckets = max(1, -(-(facts["n"] or 0) // BUCKET_TOKENS))
    word_buckets = min(max(1, buckets // 2), LANES)

    listed = blocks.select("block", "words", "counts").mapInArrow(
        _listed_words(word_buckets), "bucket long, block long, words binary, counts binary"
    )
    counted = "bucket long, blocks array<long>, maps array<binary>, words binary, classes array<struct<c:long,size:long>>"
    words = saved(listed.groupBy("bucket").applyInArrow(_counted, counted), "unigrams")
    classes = words.select("bucket", F.inline("classes"))
    # there are at most sqrt(2 N) different counts
    of = {r["c"]: r["size"] for r in classes.groupBy("c").agg(F.sum("size").alias("size")).toLocalIterator()}
    counts = np.array(sorted(of, reverse=True), np.int64)
    size = np.array([of[c] for c in counts.tolist()], np.int64)
    n_train = rows.agg(F.count_if("train").alias("n")).head()["n"]
    first = np.cumsum(size) - size
    uni = Unigrams(counts, first, int(size.sum()), int((counts * size).sum()), n_train)
    start = docs.sparkSession.createDataFrame(
        list(zip(counts.tolist(), first.tolist())), "c long, start long"
    )
    before = Window.partitionBy("c").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = classes.withColumn("ahead", F.coalesce(F.sum("size").over(before), F.lit(0)))
    firsts = ahead.join(start, "c").groupBy("bucket").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), (F.col("start") + F.col("ahead")).alias("first")))),
            lambda x: x["first"],
        ).alias("firsts")
    )
    firsts = saved(firsts, "first-numbers")
    n = firsts.agg(F.sum(F.size("firsts")).alias("n")).head()["n"] or 0
    numbers = words.drop("words").join(maybe_broadcast(firsts, n, BROADCAST_ROWS), "bucket", "left")
    numbers = numbers.select("bucket", "blocks", "maps", "classes", "firsts").mapInArrow(_numbered, "block long, bucket long, ids binary")
    numbers = numbers.groupBy("block").agg(F.collect_list(F.struct("bucket", "ids")).alias("numbers"))

    ready = blocks.drop("words", "counts").join(numbers, "block")
    pairs = ready.mapInArrow(_pair_rows(uni, word_buckets, buckets, arrow), PAIRS.format(key=name))
    stats = pairs.groupBy("bucket").applyInArrow(_bucket_stats(uni, buckets, _stats_type(arrow.value_type)), STATS.format(key=name))
    stats = saved(stats, "bigrams")
    of = stats.select(F.posexplode("of").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n"))
    seen = {r["r"]: r["n"] for r in of.collect()}
    d = discounts([seen.get(r, 0) for r in range(LOW + 1)])
    # histories that are dealt over several buckets: at most four for each bucket
    hot = stats.select(F.inline("hot")).groupBy("h")
    hot = hot.agg(F.array(*[F.sum(F.get("low", F.lit(i))) for i in range(LOW)]).alias("low"), F.sum("mass").alias("mass")).collect()
    hs = np.array([r["h"] for r in hot], np.int64)
    low = np.array([r["low"] for r in hot], np.int64).reshape(-1, LOW)
    spread = {"h": hs, "log": _backoff(uni, d, hs, low, np.array([r["mass"] for r in hot], float))}
    parts = stats.select("hs", "low", "mass", "parts").mapInArrow(_final_parts(uni, d, spread), "block long, part binary")
    homes = stats.select(F.inline("homes"))
    both = parts.unionByName(homes, allowMissingColumns=True)
    out = both.groupBy("block").applyInArrow(
        _block_scores(arrow), f"key {name}, n_tokens long, n_known long, base_score double, score double"
    )
    return out.select(
        F.col("key").alias(key),
        "n_tokens",
        "n_known",
        F.lit(uni.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def katz_report(docs: DataFrame) -> DataFrame:
    """Scores of every document; see ``op6_katz_score``."""
    held_out = crc_mod(F.col("doc_id"), 5) == 1
    out = score_texts(docs.select("doc_id", "text"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Target-distribution importance resampling: documents drawn by how much more likely the target makes them.

Runs of one to ``order`` words are hashed into buckets, and all documents and the target are counted bucket by
bucket.  A bucket's gain is the scaled logarithm of its smoothed share in the target over that in the documents; the
gains are an array that tasks look the features of their texts up in.  A document's weight is the mean gain of its
features.  With a Gumbel value of a hash of its key added, the highest scores are a draw without replacement.

The scores are a written table.  Its cutoff is found by numeric bisection: each step is a count of the rows at or
above a threshold, over the score first, then over the key of the rows that tie, then over what tells rows of one key.
The rows beyond the cutoff are partitioned by range of the order they are ranked in; a row's rank is its place in
its partition after the sizes of those before.  Only counts and thresholds come to the driver.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import TO_LOWER, WORD_BYTE, map_texts, pieces, raw, saved, texts_of, tokens

BUCKETS, ORDER, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Words up to so many bytes are hashed by tables, all at once; the rare longer ones one by one.
SHORT = 64
_ONES = np.uint32(0xFFFFFFFF)


# --- crc32 of many words ----------------------------------------------------------------------------------


def _byte_steps() -> np.ndarray:
    """What each low byte of the register turns into (the reflected polynomial of crc32)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c.astype(np.uint32)


_STEP = _byte_steps()


def _step(register: np.ndarray, byte) -> np.ndarray:
    return _STEP[(register ^ byte) & 0xFF] ^ register >> np.uint32(8)


def _zero_steps() -> np.ndarray:
    """[n, k, b]: the register after n zero bytes, if its byte k is b and its others are 0."""
    one = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [one]
    for _ in range(SHORT):
        out.append(_step(out[-1], np.uint32(0)))
    return np.stack(out)


_ZEROS = _zero_steps()


def run_hashes(own: np.ndarray, begin: np.ndarray, size: np.ndarray, order: int) -> list[np.ndarray]:
    """crc32 of every run of 1, 2, … ``order`` words joined by a space, by the run's first word.

    ``own`` has the words' bytes end to end.  A run's hash comes from that of the run without its last word: the
    register moves on by as many zero bytes as that word has, plus the word's own hash.
    """
    n = len(size)
    single = np.full(n, _ONES)
    by_size = np.argsort(-size, kind="stable")
    short = by_size[np.searchsorted(-size[by_size], -SHORT) :]
    for j in range(int(size[short[0]]) if len(short) else 0):
        now = short[: np.searchsorted(-size[short], -j, side="left")]
        single[now] = _step(single[now], own[begin[now] + j])
    single = single ^ _ONES
    long = np.flatnonzero(size > SHORT)
    texts = {int(w): own[begin[w] : begin[w] + size[w]].tobytes() for w in long}
    for w, text in texts.items():
        single[w] = zlib.crc32(text)
    out = [single]
    for k in range(1, order):
        before = out[-1][: max(n - k, 0)]
        spaced = _step(before ^ _ONES, np.uint32(32)) ^ _ONES
        step = np.minimum(size[k:], SHORT)
        joined = single[k:].copy()
        for b in range(4):
            joined ^= _ZEROS[step, b, spaced >> np.uint32(8 * b) & np.uint32(0xFF)]
        for w, text in texts.items():
            if w >= k:
                joined[w - k] = zlib.crc32(text, int(spaced[w - k]))
        out.append(joined)
    return out


def features(part: pa.Array, buckets: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its document, words of each document) of some texts."""
    buf, offsets = raw(part)
    starts, ends, _, doc = tokens(buf, offsets)
    n_words = np.bincount(doc, minlength=len(part)).astype(np.int64)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), n_words
    size = ends - starts
    hashes = run_hashes(TO_LOWER[buf[WORD_BYTE[buf]]], np.cumsum(size) - size, size, order)
    whole = [doc[: max(len(doc) - k, 0)] == doc[k:] for k in range(order)]
    owner = np.concatenate([doc[: len(w)][w] for w in whole])
    return np.concatenate([h[w] for h, w in zip(hashes, whole)]).astype(np.int64) % buckets, owner, n_words


# --- weights and scores -------------------------------------------------------------------------------------


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """How many features of all texts fall in each bucket; what the driver gets is one row a bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(texts_of(batch.column(0))):
                total += np.bincount(features(part, buckets, order)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = docs.select(F.col(text).alias("_text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(int(s), int(t)))) for s, t in zip(source, target)], np.int64)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel value that the key and the seed fix."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scores(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: list[str] = (),
    target_text: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
) -> DataFrame:
    """``key``, ``keep``, n_words, n_features, weight and score of every row, from whole texts."""
    source, goal = (bucket_counts(df, t, buckets, order) for df, t in ((docs, text), (target, target_text)))
    gain = gains(source, goal)

    def make():
        def work(part):
            bucket, doc, n_words = features(part, buckets, order)
            n = np.bincount(doc, minlength=len(part)).astype(np.int64)
            total = np.bincount(doc, gain[bucket], len(part)).astype(np.int64)  # whole numbers, exact below 2**53
            weight = np.floor_divide(total, np.maximum(n, 1))
            return [pa.array(n_words), pa.array(n), pa.array(weight)]

        return work

    cols = dict.fromkeys([key, *keep])
    fields = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    own = docs.select(F.col(text).alias("_t"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    out = map_texts(own, "_t", [f"_c{i}" for i in range(len(cols))], fields, make)
    names = {c: f"_c{i}" for i, c in enumerate(cols)}
    given = [F.col(at).alias(c) for c, at in names.items()]
    return out.select(*given, "n_words", "n_features", "weight", (F.col("weight") + gumbel(F.col("_c0"), seed)).alias("score"))


# --- the draw -----------------------------------------------------------------------------------------------


def kth_highest(rows: DataFrame, value: Column, k: int) -> tuple[int, int, int]:
    """(the k-th highest value, rows above it, rows that have it), by bisection.

    Each step is one count of all rows, which also gives the nearest values that occur on both sides of the
    threshold; so the interval ends on values of the table.  ``k`` is 1 to the number of rows.
    """
    v = rows.select(value.alias("v"))
    low, high = v.agg(F.min("v"), F.max("v")).head()
    above = 0
    while low < high:
        mid = (low + high + 1) // 2
        beyond = F.col("v") >= mid
        n, least, most = v.agg(
            F.count_if(beyond), F.min(F.when(beyond, F.col("v"))), F.max(F.when(~beyond, F.col("v")))
        ).head()
        if n >= k:
            low = least
        else:
            high, above = most, n
    return low, above, v.where(F.col("v") == low).count()


def cutoff(rows: DataFrame, order: list[Column], k: int) -> Column:
    """True for just the k rows that come first by the ``order`` columns, longs, highest first.

    The last column must tell rows apart where it matters which one is drawn.
    """
    if k <= 0:
        return F.lit(False)
    conditions: list[tuple[Column, int]] = []
    for value in order:
        v, above, ties = kth_highest(rows, value, k)
        conditions.append((value, v))
        k -= above
        if ties == k:
            break
        rows = rows.where(value == v)
    chosen = conditions[-1][0] >= conditions[-1][1]
    for value, v in reversed(conditions[:-1]):
        chosen = (value > v) | ((value == v) & chosen)
    return chosen


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their 1-based place by ``order``, highest first.

    Partitioned by range and saved with each row's place in its partition; what a partition adds is the number of
    rows before it, one row a partition.
    """
    by = [c.desc() for c in order]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    own = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    own = saved(own.withColumns({"_part": F.spark_partition_id(), "_place": place}), "ranked")
    sizes = own.groupBy("_part").agg(F.count("*").alias("n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    out = own.join(F.broadcast(starts), "_part")
    return out.withColumn(name, (F.col("_start") + F.col("_place") + 1).cast("long")).drop("_part", "_place", "_start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: list[str] = (),
    target_text: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every row's ``key``, ``keep`` columns, n_features, weight, score and rank (null if it is not drawn).

    Of the rows with at least ``least_words`` words, ``percent`` per cent (rounded down) with the highest scores are drawn;
    ties go to the smaller key, then to fewer features, then to either of two rows that nothing here tells apart.  Null and
    empty texts have no features, weight 0 and are never drawn (unless ``least_words`` is 0).  A null key is scored
    as the empty text and comes after all others in ties.  Repeated rows are rows of their own.  An empty target
    still scores: all its counts are 0.  An empty table gives no rows.  Keys are whole numbers.
    """
    rows = scores(docs, target, text, key, keep, target_text, buckets, order, seed)
    cols = [c for c in rows.columns if c not in ("n_words", "n_features", "weight", "score")]
    rows = rows.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)],
        "n_words",
        "n_features",
        "weight",
        "score",
        F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = saved(rows, "scores")
    in_order = [F.col("score"), *[F.bitwise_not(F.col(c)) for c in ("_key", "n_features", "_row")]]
    able = rows.where(F.col("n_words") >= least_words)
    k = able.count() * percent // 100
    chosen = (F.col("n_words") >= least_words) & cutoff(able, in_order, k)
    given = [F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)]
    values = ["n_features", "weight", "score"]
    drawn = ranked(rows.where(chosen), in_order, "rank").select(*given, *values, "rank")
    rest = rows.where(~chosen).select(*given, *values, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` draws, all their columns and ``rank``; nulls as there."""
    own = docs.select(F.col(text).alias("_t"), F.col(key).alias("_k"), F.struct(*docs.columns).alias("_doc"))
    out = resample(own, target, "_t", "_k", ["_doc"], **how).where(F.col("rank").isNotNull())
    names = [c for c in docs.columns if c != "rank"]
    return out.select(*[F.col("_doc").getField(c).alias(c) for c in names], "rank")


#: The same in SQL: crc32 bit by bit through a table of 256 steps that is made by its rule.
ORACLE = r"""
with steps as (select list_transform(range(256), lambda n: list_reduce(list_concat([n::bigint], range(8)),
        lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) t),
docs as (select doc_id, row_number() over () rid, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w from documents),
goal as (select list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w from benchmark),
runs as (select rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) f from docs),
goal_runs as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) f from goal),
named as (select distinct f from (select f from runs union all select f from goal_runs)),
bytes as (select f, unnest(range(octet_length(encode(f)))) i, octet_length(encode(f)) n from named),
byte_lists as (select f, list(('0x' || substr(hex(encode(f)), 2 * i::bigint + 1, 2))::bigint order by i) b from bytes group by f),
hashed as (select f, xor(list_reduce(list_concat([4294967295::bigint], b), lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])),
        4294967295) % 10000 bucket from byte_lists, steps),
s as (select bucket, count(*) n from runs join hashed using (f) group by bucket),
t as (select bucket, count(*) n from goal_runs join hashed using (f) group by bucket),
totals as (select (select coalesce(sum(n), 0) from s)::double s_all, (select coalesce(sum(n), 0) from t)::double t_all),
gain as (select b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1.0::double) * (s_all + 10000)
        / ((coalesce(s.n, 0) + 1.0::double) * (t_all + 10000))))::bigint g
    from (select unnest(range(10000)) bucket) b left join s using (bucket) left join t using (bucket), totals),
weights as (select rid, count(*) n_features, floor(sum(g)::double / count(*))::bigint weight
    from runs join hashed using (f) join gain using (bucket) group by rid),
scored as (select doc_id, rid, len(w) n_words, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
            / 4294967296)))::bigint score
    from docs left join weights using (rid)),
placed as (select *, row_number() over (order by score desc, doc_id nulls last, n_features) place from scored where n_words >= 20)
select s.doc_id, s.n_features, s.weight, s.score,
    case when place <= (select count(*) * 25 // 100 from placed) then place end "rank"
from scored s left join (select rid, place from placed) using (rid)"""

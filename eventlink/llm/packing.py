"""Batches of texts of similar length.

The histogram of all lengths is global and exact: m different lengths add up to m * m / 2 tokens at least, so it has
no more lines than the square root of twice the tokens.  Dynamic programming over it chooses the upper ends of the
length buckets so that padding every text to its bucket's end costs least.  Inside a bucket texts are
numbered without ever being gathered, and a batch takes as many as its token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlink.llm.common import maybe_broadcast, saved

BUCKETS = 16
TOKENS = 65_536
#: For :func:`histogram`, which :func:`pack` does not use.  One of up to so many lengths is taken as it is.  One with more
#: is coarser above EXACT: a line there holds the lengths of a thousandth, with the true sum of their tokens.
MOST_LINES, EXACT, FINE = 1 << 15, 1 << 14, 10
#: A bucket's texts are numbered in lanes of about so many.
LANE = 1_000_000
LANE_ROWS = 1_000_000


def word_count(text: Column) -> Column:
    """Tokens of a text by white space, and one end; null counts as empty."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def rounded(n: Column) -> Column:
    """A length as a coarse histogram has it: exact up to ``EXACT``, else rounded up by less than a thousandth."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(EXACT)).cast("double"))) - FINE).cast("long")
    return F.when(n <= EXACT, n).otherwise(F.ceil(n / step).cast("long") * step)


def every_length(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(length, texts) of each length that occurs, by rising length; ``lengths`` has ``n``, whole numbers from 0."""
    got = lengths.groupBy("n").agg(F.count("*").alias("k")).toArrow()
    n, k = got["n"].to_numpy(), got["k"].to_numpy()
    by = np.argsort(n)
    return n[by], k[by]


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(greatest length, texts, tokens) of each line, by rising length; ``lengths`` has ``n``.  A summary of bounded size.

    Not more than ``MOST_LINES`` lines as they are, or some 2,000 for each power of two above ``EXACT``.
    """
    lines = saved(lengths.groupBy("n").agg(F.count("*").alias("k")), "histogram")
    if lines.count() > MOST_LINES:
        lines = lines.groupBy(rounded(F.col("n"))).agg(
            F.max("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("n") * F.col("k")).alias("t")
        )
    else:
        lines = lines.select("n", "k", (F.col("n") * F.col("k")).alias("t"))
    got = sorted((r["n"], r["k"], r["t"]) for r in lines.toLocalIterator())
    return tuple(np.array([r[i] for r in got], np.int64) for i in range(3))


def best_ends(lengths: np.ndarray, counts: np.ndarray, buckets: int, sums: np.ndarray | None = None) -> list[int]:
    """Upper ends of at most ``buckets`` length buckets with the least padding in all; ``lengths`` rise.

    cost(i, j) of one bucket for the lines i..j-1 is end * texts - tokens; the last end is the greatest
    length.  ``sums`` are the lines' tokens, lengths times counts unless given.  Of equal plans the one with fewer and
    then with smaller ends.

    For a longer end it never pays to begin the last bucket earlier, so the best beginnings rise with the ends: those of the
    lines between two ends lie between the two ends' own, and each layer takes m log m steps.  The middles of all stretches
    that are as deep are looked at together.
    """
    m = len(lengths)
    if not m:
        return []
    sums = lengths.astype(float) * counts if sums is None else sums.astype(float)
    lengths = lengths.astype(float)
    texts = np.concatenate([[0.0], np.cumsum(counts.astype(float))])
    tokens = np.concatenate([[0.0], np.cumsum(sums)])
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    steps, totals = [], []
    for _ in range(min(buckets, m)):
        new, back = np.full(m + 1, np.inf), np.zeros(m + 1, int)
        first, last, low, high = (np.array([x]) for x in (1, m, 0, m - 1))
        while len(first):
            j = (first + last) // 2
            size = np.minimum(high, j - 1) - low + 1
            begin = np.cumsum(size) - size
            i = np.arange(size.sum()) + np.repeat(low - begin, size)
            end = np.repeat(j, size)
            cost = best[i] + lengths[end - 1] * (texts[end] - texts[i]) - (tokens[end] - tokens[i])
            new[j] = np.minimum.reduceat(cost, begin)
            hits = np.flatnonzero(cost == new[end])
            back[j] = at = i[hits[np.searchsorted(hits, begin)]]
            left, right = first < j, j < last
            first, last, low, high = (
                np.concatenate([a[left], b[right]])
                for a, b in ((first, j + 1), (j - 1, last), (low, at), (at, high))
            )
        steps.append(back)
        totals.append(new[m])
        best = new
    k = int(np.argmin(totals))
    ends, j = [], m
    while k >= 0:
        ends.append(int(lengths[j - 1]))
        j = steps[k][j]
        k -= 1
    return ends[::-1]


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = TOKENS,
) -> DataFrame:
    """Bucket and batch of every row.

    Columns: key, n_tokens, bucket (from 0, by rising end), padded (the bucket's end: tokens that the row takes
    in its batch), batch (number within the bucket), place (within the batch), n_in_batch.  A batch has
    as many rows as fit its budget at the bucket's end, one if that is longer than the budget.  ``length``
    is the number of tokens (white-space words and an end by default); null and empty texts have the end
    alone; repeated rows are batched each; rows without a key come first in their lane.
    """
    n = word_count(F.col(text)) if length is None else length
    own = docs.select(F.col(key).alias("key"), n.cast("long").alias("n"), F.xxhash64(F.col(key), F.col(text)).alias("u"))
    own = saved(own, "lengths")
    lengths, counts = every_length(own)
    ends = best_ends(lengths, counts, buckets)
    bounds = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda e: e < F.col("n"))).cast("int")
    total = int(counts.sum())
    lanes = max(1, -(-total // LANE))
    lane = F.pmod(F.shiftright("u", 8), F.lit(max(lanes, 64))).cast("int")
    placed = own.select("key", "n", "u", bucket.alias("bucket"), lane.alias("lane"))
    sizes = placed.groupBy("bucket", "lane").agg(F.count("*").alias("k"))
    before = Window.partitionBy("bucket").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("bucket").alias("b"),
        F.col("lane").alias("l"),
        F.coalesce(F.sum("k").over(before), F.lit(0)).alias("ahead"),
        F.sum("k").over(Window.partitionBy("bucket")).alias("in_bucket"),
    )
    starts = maybe_broadcast(starts, max(lanes, 64) * max(len(ends), 1), LANE_ROWS)
    inside = Window.partitionBy("bucket", "lane").orderBy("n", "u", "key")
    row = placed.withColumn("i", F.row_number().over(inside)).join(
        starts, (F.col("bucket") == F.col("b")) & (F.col("lane") == F.col("l"))
    )
    at = (F.col("ahead") + F.col("i") - 1).alias("at")
    row = row.select("key", "n", "bucket", F.get(bounds, F.col("bucket")).alias("padded"), at, "in_bucket")
    most = F.greatest(F.floor(F.lit(budget) / F.col("padded")), F.lit(1)).cast("long")
    batch = F.floor(F.col("at") / most).cast("long")
    return row.select(
        F.col("key").alias(key),
        F.col("n").alias("n_tokens"),
        "bucket",
        "padded",
        batch.alias("batch"),
        (F.col("at") - batch * most).cast("long").alias("place"),
        F.least(most, F.col("in_bucket") - batch * most).cast("long").alias("n_in_batch"),
    )

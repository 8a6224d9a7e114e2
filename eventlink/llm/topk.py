"""Exact top-k inner products by distributed histogram selection.

Vectors are packed into blocks.  A pass scores every query block against every candidate block and keeps,
for each query, a histogram of the scores within the query's current range.  Summed over all blocks the
histogram tells in which bin the query's k-th greatest score lies; that bin is the next range.  When every
range is one score wide the k-th values are known, and a last pass keeps what lies above them, and of what
equals them the smallest ids that are needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlink.llm.common import saved

#: Vectors in a block of queries and of candidates; a task scores one block pair at a time.
QUERY_BLOCK, ROW_BLOCK = 4096, 4096
#: Queries of a block that are scored together.
AT_ONCE = 512
BINS = 1024
#: Beyond this bound on a score's size doubles are not exact, and integer products are used.
EXACT = 1 << 52
#: The query blocks are broadcast up to so many bytes; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def quantised(rows: DataFrame, scale: int = 64, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, v): components floor(scale * x) as longs.

    Rows without an id, without a vector, or with a null or non-finite component take no part.  Rows of one id are
    rows of their own.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    own = rows.where(F.col(key).isNotNull() & x.isNotNull() & ~bad)
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return own.select(F.col(key).alias("id"), v.alias("v"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length: (block, dim, kind, ids, vs), packed within each task.

    ``kind`` is the narrowest integer type that holds the components; the block's name is its number in its task.
    """

    def pack(batches):
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("v")
            dims = np.asarray(lists.value_lengths(), np.int64)
            values = np.asarray(lists.flatten(), np.int64)
            begin = np.cumsum(dims) - dims
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                for i in range(0, len(own), size):
                    part = own[i : i + size]
                    m = values[begin[part][:, None] + np.arange(d)] if d else np.empty((len(part), 0), np.int64)
                    top = int(np.abs(m).max(initial=0))
                    kind = "int8" if top < 1 << 7 else "int16" if top < 1 << 15 else "int64"
                    name, n = f"{task}-{n}", n + 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name]),
                            pa.array([d], pa.int32()),
                            pa.array([kind]),
                            pa.array([top], pa.int64()),
                            pa.array([ids[part].tobytes()], pa.binary()),
                            pa.array([m.astype(kind).tobytes()], pa.binary()),
                        ],
                        names=["block", "dim", "kind", "top", "ids", "vs"],
                    )

    return rows.mapInArrow(pack, "block string, dim int, kind string, top long, ids binary, vs binary")


def _scored(row, exact: bool):
    """Parts of a block pair: query ids, their places in the block, candidate ids, scores, own cells."""
    q, c = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    kind = np.float64 if exact else np.int64
    a = np.frombuffer(row["q_vs"], row["q_kind"]).reshape(len(q), -1).astype(kind)
    b = np.frombuffer(row["vs"], row["kind"]).reshape(len(c), -1).astype(kind)
    order = np.argsort(c)
    c, b = c[order], b[order]
    for i in range(0, len(q), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        first, last = np.searchsorted(c, q[part]), np.searchsorted(c, q[part], side="right")
        same = np.repeat(np.arange(len(first)), last - first)
        at = np.arange(len(same)) - np.repeat(np.cumsum(last - first) - last, last - first)
        yield q[part], part, c, (a[part] @ b.T).astype(np.int64), (same, at)


def _histograms(row, k: int, exact: bool, step: int, width: int):
    """Counts of a block pair's scores by query and bin; bins below the k-th score here can't matter."""
    lo = np.array(row["lo"], np.int64)
    for q, part, c, s, own in _scored(row, exact):
        s -= lo[part, None]
        bins = np.where(s < 0, -1, np.where(s < width, s // step, BINS))  # BINS: above, counted in an earlier pass
        bins[own] = -1
        if len(c) > k:
            least = np.partition(bins, len(c) - k, axis=1)[:, len(c) - k]
            bins[bins < least[:, None]] = -1
        bins[bins == BINS] = -1
        at, col = np.nonzero(bins >= 0)
        cell, n = np.unique(at * BINS + bins[at, col], return_counts=True)
        yield q[cell // BINS], cell % BINS, n


def _nearest(row, exact: bool):
    """What can be among a query's greatest: all above its k-th value, the smallest ids equal to it."""
    lo, need = np.array(row["lo"], np.int64), np.array(row["need"], np.int64)
    for q, part, c, s, own in _scored(row, exact):
        other = np.ones(s.shape, bool)
        other[own] = False
        equal = (s == lo[part, None]) & other
        equal &= np.cumsum(equal, axis=1) <= need[part, None]
        i, j = np.nonzero((s > lo[part, None]) & other | equal)
        yield q[i], c[j], s[i, j]


def _over(pairs: DataFrame, work, names: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for part in work(row):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in part], names=names)

    return pairs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _listed(queries: DataFrame) -> DataFrame:
    """(block, id, at): the queries of each block in their order."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["ids"], np.int64)
                arrays = [pa.array([row["block"]] * len(q)), pa.array(q), pa.array(np.arange(len(q)), pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "id", "at"])

    return queries.select("block", "ids").mapInArrow(run, "block string, id long, at int")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` greatest inner products of each query with all rows of other ids: query_id, rank, vec_id, score.

    Both tables have (id, v); vectors of another length than the query's are not compared.  Ties go to the smaller
    id.  An id with several rows is found once for each; as a query it has the greatest of all its rows' scores
    together.  With fewer than k other rows all are returned; an empty table gives none.
    """
    rows, queries = saved(_packed(rows, ROW_BLOCK), "rows"), saved(_packed(queries, QUERY_BLOCK), "queries")
    facts = [
        t.agg(
            F.max("top").alias("top"),
            F.max("dim").alias("dim"),
            F.count("*").alias("n"),
            F.sum(F.octet_length("vs") + F.octet_length("ids")).alias("bytes"),
        ).head()
        for t in (rows, queries)
    ]
    bound = max(f["top"] or 0 for f in facts) ** 2 * max(f["dim"] or 0 for f in facts) + 1
    exact = bound < EXACT
    blocks = rows.repartition(max(1, min(facts[0]["n"], 10_000)), "block")
    listed = _listed(queries)
    state = listed.select("id").distinct().select("id", F.lit(-bound).alias("lo"), F.lit(k).cast("long").alias("need"))
    own = queries.select("block", *[F.col(c).alias(f"q_{c}") for c in ("kind", "ids", "vs", "dim")])

    def pairs(state):
        in_order = F.sort_array(F.collect_list(F.struct("at", "lo", "need")))
        s = listed.join(state, "id").groupBy("block").agg(in_order.alias("s"))
        q = own.join(s, "block").drop("block")
        q = q.select("*", F.col("s.lo").alias("lo"), F.col("s.need").alias("need")).drop("s")
        if (facts[1]["bytes"] or 0) <= BROADCAST_BYTES:
            q = F.broadcast(q)
        return blocks.select("dim", "kind", "ids", "vs").join(q, F.col("dim") == F.col("q_dim"))

    step, width = -(-(2 * bound + 1) // BINS), 2 * bound + 1
    while True:
        hist = _over(pairs(state), lambda r, s=step, w=width: _histograms(r, k, exact, s, w), ["id", "bin", "n"])
        hist = hist.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))
        hist = hist.withColumn("upto", F.sum("n").over(down)).join(state, "id")
        cell = F.struct("bin", "n", "upto")
        # the bin that holds the k-th greatest score; the lowest one where there are fewer scores
        at = hist.groupBy("id").agg(F.max(F.when(F.col("upto") >= F.col("need"), cell)).alias("hit"), F.min(cell).alias("low"))
        at = at.select("id", F.coalesce("hit", "low").alias("at"))
        state = state.join(at, "id", "left").select(
            "id",
            (F.col("lo") + F.coalesce(F.col("at.bin"), F.lit(0)) * step).alias("lo"),
            (F.col("need") - F.coalesce(F.col("at.upto") - F.col("at.n"), F.lit(0))).alias("need"),
        )
        state = saved(state, "state")
        if step == 1:
            break
        step, width = -(-step // BINS), step
    out = _over(pairs(state), lambda r: _nearest(r, exact), ["query_id", "vec_id", "score"])
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The contract of ``op5_exact_topk`` over the views of the tables.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

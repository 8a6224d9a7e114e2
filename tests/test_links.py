"""Sessions and nearest joins against plain-Python models, on random tables, for several slicings and range counts."""

import random
from contextlib import contextmanager

import models
import pytest
from pyspark.sql import functions as F

from eventlink.operators import nearest as N
from eventlink.operators import session_joins as S
from eventlink.operators import ranges
from eventlink.operators.sessions import number_rows, session_heads, sessionize
from eventlink.operators.slicing import Slicing

SLICINGS = {
    "default": Slicing(),
    "whole": Slicing(width=10**12),
    "fine": Slicing(width=3_000_000),
    "finer_than_gap": Slicing(width=700_000),
}


def table(seed, n, first_id, keys=12, span_ms=90_000):
    rng, rows = random.Random(seed), []
    for i in range(n):
        k = 0 if rng.random() < 0.4 else rng.randrange(keys)
        t = rng.randrange(0, span_ms // 500) * 500
        if rng.random() < 0.04:
            t = -1
        rows.append((None if rng.random() < 0.02 else k, t, first_id + i))
    return rows


OBS = table(1, 420, 0)
REF = table(2, 160, 10_000)


@pytest.fixture(scope="module")
def obs(spark):
    return spark.createDataFrame(OBS, "k int, ts long, row_id long").cache()


@pytest.fixture(scope="module")
def ref(spark):
    df = spark.createDataFrame(REF, "k int, ts long, row_id long")
    return df.withColumn("id", F.concat(F.lit("r"), "row_id")).cache()


def got(df, col):
    rows = df.select("row_id", col).collect()
    assert len(rows) == len(OBS) == len({r.row_id for r in rows})
    return {r.row_id: r[1] for r in rows}


def named(model):
    full = {r[2]: None for r in OBS} | model
    return {i: None if hit is None else f"r{hit}" for i, hit in full.items()}


@contextmanager
def dealt(spark, n):
    """So many ranges, however little there is in each; 0: as Spark would."""
    kept = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = {k: spark.conf.get(k) for k in kept}
    if n:
        spark.conf.set(kept[0], str(n))
        spark.conf.set(kept[1], "false")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


RANGES = [0, 3, 60]


@pytest.mark.parametrize("n", RANGES)
@pytest.mark.parametrize("cap, inclusive", [(None, True), (None, False), (1, True), (3, True)])
def test_sessionize(spark, obs, n, cap, inclusive):
    with dealt(spark, n):
        rows = sessionize(obs, ["k"], gap=2, cap=cap, inclusive=inclusive).collect()
    assert len(rows) == len(OBS)
    want = models.sessions(OBS, 2000, cap, inclusive)
    for r in rows:
        assert (r.session_seq, r.session_pos) == want.get(r.row_id, (None, None))


@pytest.mark.parametrize("n", RANGES)
def test_number_rows(spark, obs, n):
    want = models.sessions(OBS, 10**12, None)
    with dealt(spark, n):
        assert got(number_rows(obs, ["k"]), "pos") == {r[2]: want.get(r[2], (0, None))[1] for r in OBS}


def test_sessions_of_crowded_rows(spark):
    """One key holds all rows, most at one instant; the cap then cuts them in any case."""
    rows = [(1, 5_000 if i % 4 else 1_000 * i, i) for i in range(300)] + [(None, 5_000, 900), (1, -1, 901)]
    df = spark.createDataFrame(rows, "k int, ts long, row_id long")
    for cap in (None, 7):
        want = models.sessions(rows, 2000, cap)
        with dealt(spark, 40):
            out = sessionize(df, ["k"], gap=2, cap=cap).collect()
        assert len(out) == len(rows)
        assert all((r.session_seq, r.session_pos) == want.get(r.row_id, (None, None)) for r in out)


def test_an_instant_is_dealt_out(spark):
    """400,000 rows of one key at one instant: no task has more than a few ranges' share of them."""
    n = 400_000
    df = spark.range(n).select(F.lit(1).alias("k"), F.lit(7_000).cast("long").alias("ts"), F.col("id").alias("row_id"))
    with dealt(spark, 16):
        dealt_out = ranges.ranged(df, ["k", "ts", "row_id"]).groupBy("k", ranges.PART).count().agg(F.max("count")).head()[0]
        assert dealt_out < 2 * n / 16
        out = sessionize(df, ["k"], gap=30, cap=150)
        wrong = (F.col("session_seq") != F.floor(F.col("row_id") / 150) + 1) | (
            F.col("session_pos") != F.col("row_id") % 150 + 1
        )
        assert out.count() == n and out.where(wrong).count() == 0
        assert number_rows(df, ["k"]).where("pos <> row_id + 1").count() == 0


@pytest.mark.parametrize("tie", ["later", "earlier", "first"])
@pytest.mark.parametrize("name", SLICINGS)
def test_nearest_join(obs, ref, tie, name):
    df = N.nearest_join(obs, ref, ["k"], 3, ["id"], tie=tie, slicing=SLICINGS[name])
    assert got(df, "id") == named(models.nearest(OBS, REF, 3000, tie))


def test_offset_and_inner(obs, ref):
    df = N.nearest_join(obs, ref, ["k"], 3, {"found": "id"}, offset=1.5, how="inner")
    shifted = [(k, t if t == -1 else t - 1500, i) for k, t, i in REF]
    # A shifted time may be -1500…; the model's missing mark is exactly -1, which cannot occur.
    want = models.nearest(OBS, shifted, 3000, "later")
    assert {r.row_id: r.found for r in df.collect()} == {
        i: f"r{h}" for i, h in want.items() if h is not None
    }


@pytest.mark.parametrize("name", SLICINGS)
def test_prev_next(obs, ref, name):
    rows = N.prev_next(obs, ref, ["k"], ["row_id"], slicing=SLICINGS[name]).collect()
    assert len(rows) == len(OBS)
    for r in rows:
        before, after = ([], []) if r.k is None or r.ts == -1 else models.candidates(REF, r.k, r.ts)
        assert r.prev_row_id == (before[-1][1] if before else None)
        assert r.next_row_id == (after[0][1] if after else None)


@pytest.mark.parametrize("n", RANGES)
@pytest.mark.parametrize("cap", [None, 3])
def test_session_joins(spark, obs, ref, n, cap):
    kw = dict(gap=2, cap=cap)
    with dealt(spark, n):
        start = S.session_nearest_start(obs, ref, ["k"], 3, ["id"], **kw)
        assert got(start, "id") == named(models.session_start(OBS, REF, 2000, cap, 3000))
        pair = S.session_nearest_pair(obs, ref, ["k"], 3, ["id"], **kw)
        assert got(pair, "id") == named(models.session_pair(OBS, REF, 2000, cap, 3000))
        dedup = S.session_nearest_dedup(obs, ref, ["k"], 3, ["id"], **kw)
        last = {(k, t): i for k, t, i in sorted(REF, key=lambda r: r[2])}
        one = [(k, t, i) for (k, t), i in last.items()]
        want = models.session_start(OBS, one, 2000, cap, 3000, before_next=False)
        assert got(dedup, "id") == named(want)


def test_session_joins_carry_far(spark):
    """A key without references for many ranges, and a session over many ranges whose only reference is at its end."""
    obs = [(1, 1_000 * i, i) for i in range(200)] + [(2, 5_000, 500)]
    ref = [(1, 199_400, 10_001), (2, 5_900, 10_002)]
    o = spark.createDataFrame(obs, "k int, ts long, row_id long")
    r = spark.createDataFrame(ref, "k int, ts long, row_id long").withColumn("id", F.concat(F.lit("r"), "row_id"))
    with dealt(spark, 30):
        pair = S.session_nearest_pair(o, r, ["k"], 3, ["id"], gap=2, cap=None).collect()
        assert {x.id for x in pair if x.k == 1} == {"r10001"} and len(pair) == len(obs)
        assert {x.distance for x in pair if x.k == 1} == {400_000}
        start = S.session_nearest_start(o, r, ["k"], 1000, ["id"], gap=2, cap=None, how="inner").collect()
        assert {x.id for x in start if x.k == 1} == {"r10001"} and len(start) == len(obs)
        near = S.session_nearest_start(o, r, ["k"], 3, ["id"], gap=2, cap=None)
        assert near.where("session_matched").select("k", "id", "session_seq").collect() == [(2, "r10002", 1)]


def test_session_joins_of_nothing(spark, obs, ref):
    for o, r, n in [(obs.limit(0), ref, 0), (obs, ref.limit(0), len(OBS)), (obs.where("k is null"), ref, None)]:
        for join in (S.session_nearest_start, S.session_nearest_pair, S.session_nearest_dedup, S.segment_last_in_window):
            out = join(o, r, ["k"], 3, ["id"])
            assert out.count() == (n if n is not None else o.count())
            assert out.where("id is not null or session_matched").count() == 0


def test_offset_in_session_joins(spark, obs, ref):
    shifted = [(k, t if t == -1 else t - 1500, i) for k, t, i in REF]
    out = S.session_nearest_pair(obs, ref, ["k"], 3, ["id"], gap=2, cap=3, offset=1.5)
    assert got(out, "id") == named(models.session_pair(OBS, shifted, 2000, 3, 3000))


@pytest.mark.parametrize("n", RANGES)
def test_segment_latest(spark, obs, ref, n):
    with dealt(spark, n):
        df = S.segment_last_in_window(obs, ref, ["k"], 3, ["id"], gap=2, latest="time")
        assert got(df, "id") == named(models.segment_last(OBS, REF, 2000, 3000))


@pytest.mark.parametrize("window", [0.5, 3, 40])
def test_segment_last(spark, obs, ref, window):
    """The references' list has another order than time, and every fifth has no id."""
    listed = ref.select("k", "ts", "row_id", F.when(F.col("row_id") % 5 != 0, F.col("id")).alias("id"),
                        ((F.col("row_id") * 7919) % 1009).alias("at"))
    in_order = sorted((r for r in REF if r[2] % 5), key=lambda r: r[2] * 7919 % 1009)
    df = S.segment_last_in_window(obs, listed, ["k"], window, ["id"], gap=2, ref_order=["at"])
    assert got(df, "id") == named(models.segment_last_listed(OBS, in_order, 2000, round(1000 * window)))


@pytest.mark.parametrize("window", [0.5, 3, 40])
def test_last_listed(obs, ref, window):
    df = N.last_listed(obs, ref.withColumn("at", F.col("row_id") * 7919 % 1009), ["k"], window, ["id"], ref_order=["at"])
    in_order = sorted(REF, key=lambda r: r[2] * 7919 % 1009)
    want = {}
    for k, t, i in OBS:
        for rk, rt, ri in in_order:
            if None not in (k, rk) and -1 not in (t, rt) and k == rk and abs(rt - t) < round(1000 * window):
                want[i] = ri
    assert got(df, "id") == named(want)


def test_session_heads(obs):
    rows = sessionize(obs, ["k"], gap=2, cap=3)
    heads = session_heads(rows, ["k"], "ts", ["row_id"]).collect()
    groups = models.session_members(OBS, 2000, 3)
    assert len(heads) == len(groups)
    for h in heads:
        members = groups[(h.k, h.session_seq)]
        following = groups.get((h.k, h.session_seq + 1))
        assert (h.start_ts, h.start_row_id) == (members[0][1], members[0][2])
        assert (h.end_ts, h.n_rows) == (members[-1][1], len(members))
        assert h.next_start_ts == (following[0][1] if following else None)

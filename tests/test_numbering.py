"""Row numbers: keys that one task numbers, keys that are dealt out by ranges, and rows without a key or time."""

import random

import pytest
from pyspark.sql import functions as F

from eventlink.operators import merge, sessions


def rows_of(seed, n=600):
    """A key with a third of all rows, rows that repeat, and some without key or time."""
    rng = random.Random(seed)
    rows = [(rng.choice([0, 0, 0, None, *range(1, 7)]), rng.choice([-1, *range(0, 40_000, 500)]), i) for i in range(n)]
    return rows + rows[:5]


def numbered(rows):
    keys = {}
    for k, t, i in rows:
        if k is not None and t != -1:
            keys.setdefault(k, []).append((t, i))
    out = [(k, t, i, p) for k, own in keys.items() for p, (t, i) in enumerate(sorted(own), 1)]
    return out + [(k, t, i, None) for k, t, i in rows if k is None or t == -1]


@pytest.mark.parametrize("most", [1, 60, 1_000_000])
def test_numbers_do_not_depend_on_the_bound(spark, monkeypatch, most):
    monkeypatch.setattr(sessions, "KEY_ROWS", most)
    rows = rows_of(most)
    df = spark.createDataFrame(rows, "k int, ts long, row_id long")
    out = sessions.number_rows(df, ["k"])
    assert out.columns == ["k", "ts", "row_id", "pos"] and out.schema["pos"].dataType.simpleString() == "bigint"
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, numbered(rows)))
    assert sessions.number_rows(df.limit(0), ["k"]).count() == 0


def test_rows_are_not_written_to_be_numbered(spark, monkeypatch):
    """Keys of a usual size go through one shuffle; only rows of larger keys are stored on the way."""
    kept, stored = [], sessions.stored

    def counted(df, name):
        kept.append(stored(df, name))
        return kept[-1]

    monkeypatch.setattr(sessions, "stored", counted)
    df = spark.range(3_000).select(
        F.floor(F.col("id") / 4).alias("k"), F.col("id").alias("line"), F.array(F.col("id").cast("string")).alias("cells")
    )
    out = merge.merge_arrays_long(df, ["k"], ["cells"], ["line"])
    assert out.where("cells <> cast(4 * k + pos - 1 as string)").count() == 0 and out.count() == 3_000
    assert sum(df.count() for df in kept) == 0

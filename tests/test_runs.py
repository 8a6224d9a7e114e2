"""Hourly runs: one by one, as one job, and again for late references."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventlink.plans import jobs, runs, views
from eventlink.sources import folders

DAY = "20240102"
START = 1_704_153_600_000  # midnight of that day
FIELDS = "row_id long, ts long, k long, id string"


def records(seed, n, first_id, prefix):
    """Times over the day and an hour on both sides; some without a time."""
    r = random.Random(seed)
    span = 26 * 3_600_000
    return [
        (first_id + i, -1 if r.random() < 0.03 else START - 3_600_000 + r.randrange(span // 500) * 500, r.randrange(3),
         f"{prefix}{i}" if prefix == "r" or r.random() < 0.3 else None)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def obs(spark):
    return views.by_hour(spark.createDataFrame(records(1, 900, 0, "own"), FIELDS), "ts").cache()


@pytest.fixture(scope="module")
def ref(spark):
    rows = spark.createDataFrame(records(2, 500, 10_000, "r"), FIELDS).withColumnRenamed("ts", "start_ts")
    return views.by_hour(rows.withColumn("end_ts", F.col("start_ts")), "start_ts").cache()


HOW = dict(on=["k"], decode_obs=lambda df: df, decode_ref=lambda df: df)
HOURS = [f"{h:02d}" for h in range(24)]


def values(df):
    return sorted(map(tuple, df.select("row_id", "id", "matched", "distance", "day", "hour").collect()), key=str)


@pytest.mark.parametrize("around", [runs.Around(), runs.Around(0, 0), runs.Around(20, 45), runs.Around(120, 90)])
def test_hours_as_one_job(spark, obs, ref, around):
    """The same as the day's 24 runs one by one."""
    whole = runs.backfill_hours(obs, ref, runs.hours_of_day(spark, DAY), around, bound=1800, **HOW)
    one_by_one = []
    for h in HOURS if around == runs.Around() else HOURS[:4]:
        one_by_one += values(runs.backfill_hour(obs, ref, DAY, h, around, bound=1800, **HOW))
    got = [r for r in values(whole) if r[-1] in {x[-1] for x in one_by_one}]
    assert got == sorted(one_by_one, key=str) and len(got) > 50


def test_hours_together_are_the_day(spark, obs, ref):
    """Where the look-around covers the bound, the hours' runs give what one run over everything gives."""
    around = runs.Around(30, 30)
    got = runs.backfill_hours(obs, ref, runs.hours_of_day(spark, DAY), around, bound=1800, **HOW)
    want = jobs.backfill(obs, ref.drop("day", "hour"), bound=1800, **HOW).where(F.col("day") == DAY)
    assert values(got) == values(want) and got.where("matched").count() > 100
    less = runs.backfill_hours(obs, ref, runs.hours_of_day(spark, DAY), runs.Around(1, 0), bound=1800, **HOW)
    assert less.where("matched").count() < got.where("matched").count()


def contents(path):
    out = {}
    for at, _, names in os.walk(path):
        out.update({os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns for n in names if n.endswith("parquet")})
    return out


def test_one_folder_is_replaced(spark, obs, ref, tmp_path):
    path = str(tmp_path / "out")
    for h in ("09", "10", "11"):
        runs.write_hour(runs.backfill_hour(obs, ref, DAY, h, bound=1800, **HOW), path, DAY, h)
    before = contents(path)
    runs.write_hour(runs.backfill_hour(obs, ref, DAY, "10", runs.Around(1, 0), bound=1800, **HOW), path, DAY, "10")
    after = contents(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if "hour=10" not in f} and all("hour=10" in f for f in after.keys() - same)
    runs.write_hour(obs.limit(0), path, DAY, "11")  # a run without rows leaves an empty folder
    back = spark.read.parquet(path)
    assert {r.hour for r in back.select(F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour")).distinct().collect()} == {"09", "10"}


def test_folders_are_pruned(spark, obs, ref, tmp_path):
    """An hour's run lists just its own folder of observations and those of the hours around of references."""
    inputs = []
    for name, df in (("obs", obs), ("ref", ref)):
        df.where("day is not null").write.partitionBy("day", "hour").parquet(str(tmp_path / name))
        inputs.append(spark.read.schema(df.schema).parquet(str(tmp_path / name)))
    mine, refs = runs.hour_inputs(*inputs, DAY, "10", runs.Around(20, 0))
    for df, n in ((mine, 1), (refs, 3)):  # the last moment of a run is the first of the next hour
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
        assert len({os.path.dirname(f) for f in df.inputFiles()}) >= n
        read = {r[0] for r in df.select(F.regexp_extract(F.input_file_name(), "hour=(..)", 1)).distinct().collect()}
        assert len(read) <= n
    assert values(runs.backfill_hour(*inputs, DAY, "10", bound=1800, **HOW)) == values(
        runs.backfill_hour(obs, ref, DAY, "10", bound=1800, **HOW)
    )


@pytest.mark.parametrize("offset", [0, 900])
def test_late_references(spark, obs, ref, tmp_path, offset):
    """The hours that late references reach are run again; the result is that of a run with all references, and the
    other hours' files stay."""
    path, around, day = str(tmp_path / "out"), runs.Around(30, 30), runs.hours_of_day(spark, DAY)
    late = (F.col("row_id") % 3 == 0) & F.col("hour").between("09", "11")
    how = dict(around=around, bound=1200, offset=offset, **HOW)
    take = lambda df: jobs.backfill_output(df).select("row_id", "id", "matched", "distance", "day", "hour")
    folders.write_hours(take(runs.backfill_hours(obs, ref.where(~late | late.isNull()), day, **how)), path, "parquet")
    before = contents(path)
    hours = runs.backfill_late(obs, ref, ref.where(late), path, within=day, finish=take, **how)
    again = {r.hour for r in hours.collect()}
    assert {"09", "10", "11"} <= again and len(again) < 8
    after = contents(path)
    stay = {f for f in before if f.split("hour=")[1][:2] not in again}
    assert stay and all(after[f] == before[f] for f in stay)
    assert not any(f in after for f in before.keys() - stay)
    schema = "row_id long, id string, matched boolean, distance long, day string, hour string"
    back = spark.read.schema(schema).parquet(path)
    assert values(back) == values(take(runs.backfill_hours(obs, ref, day, **how)))


def test_late_references_may_empty_an_hour(spark, tmp_path):
    """An observation whose id a late reference takes away: the hour's folder is empty afterwards."""
    fields = "row_id long, ts long, k long, id string"
    obs = views.by_hour(spark.createDataFrame([(1, START + 60_000, 1, "own")], fields), "ts")
    late = spark.createDataFrame([(9, START + 61_000, 1, "")], fields).withColumnRenamed("ts", "start_ts")
    late = views.by_hour(late.withColumn("end_ts", F.col("start_ts")), "start_ts")
    path, day = str(tmp_path / "out"), runs.hours_of_day(spark, DAY)
    take = lambda df: jobs.backfill_output(df).select("row_id", "id", "matched", "distance", "day", "hour")
    folders.write_hours(take(runs.backfill_hours(obs, late.limit(0), day, **HOW)), path, "parquet")
    schema = "row_id long, id string, matched boolean, distance long, day string, hour string"
    assert spark.read.schema(schema).parquet(path).count() == 1
    runs.backfill_late(obs, late, late, path, within=day, finish=take, **HOW)
    assert spark.read.schema(schema).parquet(path).count() == 0


def test_hours_reached(spark):
    """From the time of a late reference to the hours whose runs see it and have observations near enough."""

    def hours(ms, around, bound, offset=0):
        df = spark.createDataFrame([(ms,), (-1,), (None,)], "start_ts long")
        return sorted(f"{r.day}{r.hour}" for r in runs.hours_reached(df, around, bound, "start_ts", offset).collect())

    ten = START + 10 * 3_600_000
    assert hours(ten + 1_800_000, runs.Around(20, 0), 30) == ["2024010210"]
    assert hours(ten - 10_000, runs.Around(20, 0), 30) == ["2024010209", "2024010210"]
    assert hours(ten + 10_000, runs.Around(20, 0), 30) == ["2024010210"]  # the run before does not look that far
    assert hours(ten, runs.Around(20, 0), 30) == ["2024010209", "2024010210"]  # its last moment
    assert hours(ten + 10_000, runs.Around(20, 1), 30) == ["2024010209", "2024010210"]
    assert hours(ten - 1_300_000, runs.Around(20, 0), 3600) == ["2024010209"]  # further before than the look-around
    assert hours(ten + 10_000, runs.Around(20, 1), 30, offset=60) == ["2024010209"]
    assert hours(START, runs.Around(), 30) == ["2024010123", "2024010200"]

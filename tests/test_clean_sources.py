import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlink.functions import geo, ids, times
from eventlink.operators import clean, merge, words
from eventlink.sources import folders, schemas


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_parse_delimited(spark):
    lines = ["a,5", "b,1,2,3,more", "c,,7,", "d,x,1,1", "\\N,1,1,-1", "e"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, line string")
    got = rows(clean.parse_delimited(df, "line", schemas.SIGNALLING_FIELDS, keep=["n"]), "n")
    assert got == [
        (0, "a", 5, None, None, False),
        (1, "b", 1, 2, 3, False),
        (2, "c", None, 7, None, True),
        (3, "d", None, 1, 1, True),
        (4, "\\N", 1, 1, -1, False),
        (5, "e", None, None, None, False),
    ]
    good, bad = clean.split_bad(clean.parse_delimited(df, "line", schemas.SIGNALLING_FIELDS))
    assert (good.count(), bad.count()) == (4, 2)


def test_neighbour_arrays(spark):
    df = spark.createDataFrame([("1;2", "3;x", "-80.5;")], "a string, b string, c string")
    cells, rsrp = clean.neighbour_arrays(F.col("a"), F.col("b"), F.col("c"))
    r = df.select(cells.alias("cells"), rsrp.alias("rsrp")).head()
    assert [tuple(c) for c in r.cells] == [(1, 3), (2, None)] and r.rsrp == [-80.5, None]
    assert df.select(clean.number_list(F.lit("")).alias("x")).head().x == []
    lists = [("1;2", "3;4", "-80.5"), ("1;x", "3;4", "-80.5"), ("", "", ""), ("1", "2", "-80.5;"), (None, "1", "1")]
    df = spark.createDataFrame(lists, "a string, b string, c string")
    bad = df.select(clean.neighbours_bad(F.col("a"), F.col("b"), F.col("c")).alias("bad"))
    assert [r.bad for r in bad.collect()] == [False, True, False, True, False]


def test_day_slice_asks_the_scan(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1705276800) + F.col("id") * 3600).cast("timestamp_ntz")  # 2024-01-15 on
    spark.range(48).select(at.alias("at")).write.parquet(str(tmp_path / "t"))
    df = folders.with_hour(spark.read.parquet(str(tmp_path / "t")), "at")
    one = folders.day_slice(df, "20240115", time="at")
    assert one.count() == 24 and folders.day_slice(df, "20240116", 5, time="at").count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2024-01-15T00:00)" in plan


def test_filters(spark):
    ref = spark.createDataFrame(
        [(1, 5, 6, "a"), (2, -1, 6, "a"), (3, 5, -1, "a"), (4, 5, 6, None), (5, 5, 6, "\\N"), (6, 5, 6, "")],
        "n int, start_ts long, end_ts long, id string",
    )
    assert [r.n for r in ref.where(clean.valid_reference()).orderBy("n").collect()] == [1, 6]
    assert [r.n for r in ref.where(clean.valid_location()).orderBy("n").collect()] == [1, 5]
    keys = spark.createDataFrame([(1, 2), (ids.ALL_ONES, 2), (1, ids.ALL_ONES)], "a long, b long")
    assert keys.where(clean.no_sentinel("a", "b")).count() == 1
    lonlat = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (1.0, 0.0)], "lon double, lat double")
    assert lonlat.where(clean.nonzero_lonlat()).count() == 1


def test_time_range_is_inclusive_and_pushed_down(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    data = [(at + dt.timedelta(minutes=m),) for m in (0, 39, 40, 60, 120, 121)]
    spark.createDataFrame(data, "ts timestamp_ntz").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = clean.time_range(df, "ts", *times.reference_range("20240101", 1))
    assert sorted(r.ts for r in out.collect()) == [data[2][0], data[3][0], data[4][0]]
    assert "GreaterThanOrEqual(ts," in plan(out)
    assert clean.time_range(df, "ts", None, at) is df
    raw = spark.createDataFrame([(1704067199999,), (1704067200000,), (1704067260000,)], "ts long")
    assert clean.time_range(raw, "ts", at, at + dt.timedelta(minutes=1)).count() == 2


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reference_range():
    day = dt.datetime(2024, 1, 1)
    assert times.reference_range("20240101", "00", 0, 5) == (
        day - dt.timedelta(minutes=20),
        day + dt.timedelta(minutes=65),
    )
    hours = times.hours_between(*times.reference_range("20240101", 0))
    assert hours == [("20231231", "23"), ("20240101", "00"), ("20240101", "01")]
    assert folders.hour_paths("/in", "20240101", 0)[0] == "/in/2023123123"
    assert folders.hour_paths("/in/", "20240101", 0, nested=True)[1] == "/in/20240101/00"


def test_hour_slice_prunes_folders(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    data = [(at + dt.timedelta(minutes=15 * i), i) for i in range(96)]
    df = folders.with_hour(spark.createDataFrame(data, "ts timestamp_ntz, n int"))
    path = str(tmp_path / "hours")
    folders.write_hours(df, path, fmt="parquet")
    kinds = "ts timestamp_ntz, n int, day string, hour string"
    stored = spark.read.schema(kinds).parquet(path)
    out = folders.hour_slice(stored, "20240101", 7, time="ts")
    assert sorted(r.n for r in out.collect()) == list(range(27, 33))
    filters = plan(out).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "day#" in filters and "hour#" in filters
    # A second run replaces the folders it writes and no others.
    folders.write_hours(df.where("hour = '07'").withColumn("n", F.lit(-1)), path, fmt="parquet")
    again = spark.read.schema(kinds).parquet(path)
    assert (again.count(), again.where("n = -1").count()) == (96, 4)
    assert folders.day_slice(again, "20240101", 7).count() == 4
    assert folders.day_slice(again).count() == 96


def test_scan_delimited(spark, tmp_path):
    (tmp_path / "in/a/b").mkdir(parents=True)
    (tmp_path / "in/a/one.csv").write_text("a,5\n\\N,1,2,3\n")
    (tmp_path / "in/a/b/two.csv").write_text("c,1,x,4\n")
    (tmp_path / "in/a/skip.log").write_text("d,1,1,1\n")
    df = folders.scan_delimited(
        spark,
        str(tmp_path / "in"),
        schemas.struct(schemas.SIGNALLING_FIELDS),
        name_filter="*.csv",
        bad_records=True,
    )
    got = {(r.id, r.eci, r.start_ts) for r in df.select("id", "eci", "start_ts").collect()}
    assert got == {("a", 5, None), (None, 1, 3), ("c", 1, 4)}
    assert "c,1,x,4" in {r._corrupt_record for r in df.collect()}


def test_load_grid_and_stored(spark, tmp_path):
    (tmp_path / "bd.csv").write_text("Bd,1000,260,-0.006,-0.001\n")
    (tmp_path / "gd.csv").write_text("Gd,1000,261,-0.005,-0.002\n")
    grid = folders.load_grid(spark, str(tmp_path))
    again = folders.stored(grid, "grid")
    assert again.schema == grid.schema
    assert rows(again, "system") == [
        ("Bd", 1000, 260, -0.006, -0.001),
        ("Gd", 1000, 261, -0.005, -0.002),
    ]


def test_merge_arrays(spark):
    data = [(g, i, [f"{g}-{i}"], f"s{i}") for g, n in (("big", 50), ("small", 2)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, pos int, a array<string>, s string").repartition(5)
    whole = rows(merge.merge_arrays(df, ["g"], ["a"], ["pos"], ["s"]), "g")
    assert whole == [
        ("big", "s0", [f"big-{i}" for i in range(50)], 50),
        ("small", "s0", ["small-0", "small-1"], 2),
    ]
    long = rows(merge.merge_arrays_long(df, ["g"], ["a"], ["pos"]), "g", "pos")
    assert long == [(g, i + 1, f"{g}-{i}") for g, n in (("big", 50), ("small", 2)) for i in range(n)]


def test_merge_arrays_is_one_row_per_group(spark):
    """Many groups of equal size, their rows at two order values only."""
    df = spark.range(300 * 4_000).select(
        (F.col("id") % 300).alias("g"),
        (F.col("id") % 7 % 2).alias("at"),
        F.col("id").alias("row"),
        F.array(F.col("id")).alias("a"),
    )
    out = merge.merge_arrays(df, ["g"], ["a"], ["at", "row"]).select("g", F.size("a").alias("n"))
    assert {(r.g, r.n) for r in out.collect()} == {(g, 4_000) for g in range(300)}
    assert out.count() == 300


def test_long_merge_of_uneven_lists(spark):
    df = spark.createDataFrame([(1, 2, ["c"], [3]), (1, 1, ["a", "b"], [1]), (2, 1, [], [])], "g int, at int, a array<string>, b array<int>")
    got = rows(merge.merge_arrays_long(df, ["g"], ["a", "b"], ["at"]), "g", "pos")
    assert got == [(1, 1, "a", 1), (1, 2, "b", None), (1, 3, "c", 3)]


def test_words(spark):
    df = spark.createDataFrame([(" a\tb a\n\r\fc d\v ",), ("",), (None,)], "text string")
    counts = words.word_count(df, "text")
    assert rows(counts, "word") == [("a", 2), ("b", 1), ("c d\v", 1)]
    assert tuple(words.word_totals(counts).head()) == (4, 3)


def test_times_of_every_type(spark):
    sql = "select timestamp_ntz'1969-12-31 23:59:58.5' a, 1500L b, -1L c, timestamp'1970-01-01 00:00:01Z' d"
    df = spark.sql(sql)
    want = (-1_500_000, 1_500_000, None, 1_000_000)
    assert tuple(df.select(*[times.micros(df, c).alias(c) for c in "abcd"]).head()) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(df.select(*[times.micros(df, c).alias(c) for c in "abcd"]).head()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scalars(spark):
    one = spark.range(1)
    got = one.select(
        times.duration_text(F.lit(90_061_999).cast("long")).alias("d"),
        times.parse_hour(F.lit("20240229"), F.lit("5")).alias("h"),
        ids.site_of(F.lit(515).cast("long")).alias("s"),
        ids.hashed_id(F.lit("x"), "salt").alias("x"),
        ids.hashed_id(F.lit(None).cast("string"), "salt").alias("n"),
        geo.system_name(F.lit(7)).alias("g"),
    ).head()
    assert (got.d, got.h, got.s, got.g, got.n) == ("25:1:1", dt.datetime(2024, 2, 29, 5), 2, "Gps", None)
    assert len(got.x) == 64


@pytest.mark.parametrize(
    "lon, lat, x, y",
    # Central meridian, equator, and a point checked against the meridian arc length to 45°N.
    [(99.0, 0.0, 500000.0, 0.0), (99.0, 45.0, 500000.0, 4984944.378)],
)
def test_projection(spark, lon, lat, x, y):
    px, py = geo.transverse_mercator(F.lit(lon), F.lit(lat), 99.0)
    r = spark.range(1).select(px.alias("x"), py.alias("y")).head()
    assert abs(r.x - x) < 1e-6 and abs(r.y - y) < 0.01

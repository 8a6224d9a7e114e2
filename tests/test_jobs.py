"""Edge cases of the joins, locations, reports and whole jobs on hand-made tables."""

import pytest
from pyspark.sql import functions as F

from eventlink.operators import location, nearest, quality, session_joins
from eventlink.plans import jobs
from eventlink.sources import folders

OBS = "k int, ts long, row_id long"


def link(spark, obs, ref, tie="later"):
    o = spark.createDataFrame([(1, t, i) for i, t in enumerate(obs)], OBS)
    r = spark.createDataFrame([(1, t, i, x) for i, (t, x) in enumerate(ref)], OBS + ", id string")
    out = nearest.nearest_join(o, r, ["k"], 30, ["id"], tie=tie).orderBy("row_id")
    return [x.id for x in out.collect()]


@pytest.mark.parametrize(
    "obs, ref, tie, want",
    [
        ([100_000], [(130_000, "a")], "later", [None]),
        ([100_000], [(70_000, "a")], "later", [None]),
        ([100_000], [(129_999, "a")], "later", ["a"]),
        ([100_000], [(90_000, "a"), (110_000, "b")], "later", ["b"]),
        ([100_000], [(90_000, "a"), (110_000, "b")], "earlier", ["a"]),
        ([100_000], [(110_000, "b"), (90_000, "a")], "first", ["b"]),
        ([100_000], [(95_000, "a")], "later", ["a"]),
        ([100_000], [(100_000, "a"), (100_000, "b")], "later", ["b"]),
        ([100_000], [(101_000, "a"), (101_000, "b")], "later", ["a"]),
        ([-1, 100_000], [(100_000, "a"), (-1, "b")], "later", [None, "a"]),
        ([100_000], [], "later", [None]),
        ([], [(1, "a")], "later", []),
    ],
)
def test_nearest_edges(spark, obs, ref, tie, want):
    assert link(spark, obs, ref, tie) == want


@pytest.mark.parametrize(
    "obs, ref, gap, want",
    [
        ([0, 31_000], [(20_000, "a"), (40_000, "b")], 30, ["a", "b"]),
        ([1_000, 15_000], [(20_000, "a")], 10, [None, "a"]),
        ([1_000, 2_000], [(5_000, "a")], 10, ["a", "a"]),
    ],
)
def test_session_start_edges(spark, obs, ref, gap, want):
    o = spark.createDataFrame([(1, t, i) for i, t in enumerate(obs)], OBS)
    r = spark.createDataFrame([(1, t, i, x) for i, (t, x) in enumerate(ref)], OBS + ", id string")
    out = session_joins.session_nearest_start(o, r, ["k"], 30, ["id"], gap=gap).orderBy("row_id")
    assert [x.id for x in out.collect()] == want


@pytest.fixture(scope="module")
def grid(spark):
    kinds = "system string, cell_x int, cell_y int, dlon double, dlat double"
    return spark.createDataFrame([("Bd", 1000, 260, -0.006, -0.001), ("Gd", 1, 1, -0.15, 0.0)], kinds)


def test_to_gps(spark, grid):
    data = [
        (0, 100.05, 26.05, 0),
        (1, 100.05, 26.05, 1),
        (2, 100.05, 26.05, 2),
        (3, 100.05, 26.05, 9),
        (4, 0.15, 0.15, 2),
    ]
    df = spark.createDataFrame(data, "n int, lon double, lat double, locate_system int")
    got = [tuple(r) for r in location.to_gps(df, grid).orderBy("n").select("lon", "lat", "converted").collect()]
    assert got == [
        (100.05, 26.05, True),
        (100.044, 26.049, True),
        (None, None, False),
        (100.05, 26.05, True),
        (None, None, False),
    ]


def test_convert_after_or_before(spark, grid):
    o = spark.createDataFrame([(1, 100_000, 0), (2, 100_000, 1)], OBS)
    loc = spark.createDataFrame(
        # The nearest one cannot be converted; the next nearest one can.
        [(1, 101_000, 0, 100.05, 26.05, 2), (1, 105_000, 1, 100.05, 26.05, 1)],
        OBS + ", lon double, lat double, locate_system int",
    )
    after = location.nearest_location(o, loc, grid, ["k"]).orderBy("row_id").collect()
    assert [(r.lon, r.converted) for r in after] == [(None, False), (None, None)]
    before = location.nearest_location(o, loc, grid, ["k"], convert_first=True).orderBy("row_id")
    assert [(r.lon, r.converted) for r in before.collect()] == [(100.044, True), (None, None)]
    assert location.nearest_location(o, loc, grid, ["k"], convert_first=True, how="inner").count() == 1


RAW_OBS = """row_id long, ts long, mme_ue_s1ap_id long, eci long, mme_group_id int, mme_code int,
    id string, nc_cells array<int>, nc_rsrp array<double>"""
RAW_REF = "row_id long, id string, eci long, mme_ue_s1ap_id long, start_ts long, end_ts long"


def raw(spark):
    obs = [
        (0, 100_000, 7, 515, 1, 1, None, [1], [-80.0]),
        (1, 100_000, 7, 515, 1, 1, None, [2, 3], [-81.0, -82.0]),
        (2, 300_000, 7, 515, 1, 1, "z", [], []),
        (3, -1, 7, 515, 1, 1, "", [], []),
        (4, 100_000, 8, 515, 1, 1, None, [], []),
    ]
    ref = [
        (0, "a", 600, 7, 101_000, 102_000),
        (1, "\\N", 600, 7, 100_000, 102_000),
        (2, "b", 600, 7, 100_000, -1),
        (3, "c", 1000, 8, 100_000, 102_000),
    ]
    return spark.createDataFrame(obs, RAW_OBS), spark.createDataFrame(ref, RAW_REF)


def test_backfill_job(spark):
    obs, ref = raw(spark)
    filled = jobs.backfill(obs, ref)
    got = [(r.row_id, r.id, r.matched) for r in filled.orderBy("row_id").collect()]
    # Keys are site and connection: row 4 has connection 8, but its reference is at another site.
    want = [(0, "a", True), (1, "a", True), (2, "z", False), (3, "", False), (4, None, False)]
    assert got == want
    assert jobs.backfill_output(filled).count() == 3
    report = jobs.backfill_report(obs.withColumn("is_bad", F.lit(False)), ref, filled).head()
    assert (report.rows_ok, report.refs_ok, report.refs_bad) == (5, 2, 2)
    assert (report.matched, report.unmatched, report.no_time, report.ratio) == (2, 2, 1, 0.5)
    none = jobs.backfill_report(obs.limit(0).withColumn("is_bad", F.lit(False)), ref, filled.limit(0))
    assert none.head().ratio is None


def test_backfill_with_merge(spark):
    obs, ref = raw(spark)
    out = jobs.backfill(obs, ref, merge=True).where("ts = 100000 and mme_ue_s1ap_id = 7").collect()
    assert [(r.row_id, r.nc_cells, r.nc_rsrp, r.id) for r in out] == [
        (0, [1, 2, 3], [-80.0, -81.0, -82.0], "a")
    ]
    # The two pieces are one observation: exactly one row, its scalars from the first piece.
    passed = jobs.backfill(obs, None, merge=True)
    assert passed.count() == 4 and passed.where("matched").count() == 0


def test_counters_while_writing(spark, tmp_path):
    obs, ref = raw(spark)
    out, watch = jobs.counted(jobs.backfill(obs, ref))
    at = F.timestamp_millis(F.greatest("ts", F.lit(0)))
    out = folders.with_hour(out.drop("nc_cells", "nc_rsrp").withColumn("at", at), "at")
    jobs.write_run(out, str(tmp_path / "out"), salt="s", fmt="parquet")
    assert watch.get == {"rows_merged": 5, "matched": 2, "unmatched": 2, "no_time": 1}
    ids = {r.id for r in spark.read.parquet(str(tmp_path / "out")).select("id").collect()}
    assert "a" not in ids and "z" not in ids


def test_session_counts(spark):
    df = spark.createDataFrame([(3, True), (2, False), (1, None)], "n long, hit boolean")
    assert tuple(quality.session_counts(df, "n", "hit").head()) == (1, 2, 3, 3, 0.5)

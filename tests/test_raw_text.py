"""From raw text to results: record shapes, decoders as a data source, outcomes, counters of a run, folders as found."""

import io
import os

import pytest
from pyspark.sql import functions as F

from eventlink.operators import shapes
from eventlink.plans import jobs, views
from eventlink.sources import decoded, folders, schemas

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# --- the two shapes --------------------------------------------------------------------------------

BASIC = ["1000", "7", "view", "1", "515", "2", "id1"]
GOOD = dict(ts=1000, mme_ue_s1ap_id=7, event_type="view", mme_code=1, eci=515, mme_group_id=2, id="id1")


def line(shape="P", basic=BASIC, serving=("10", "20", "-80.5"), lists=("11;12", "21;22", "-81.5;")):
    if shape == "P":
        return ",".join(["P", *basic, *serving, *lists])
    return "|".join([shape, ";".join(basic), ";".join(serving), *lists])


CASES = [
    (line(), None),
    (line("L"), None),
    (line(lists=("", "", "")), None),
    (line("L", lists=("", "", "")), None),
    (line(basic=["", "7", "", "", "515", "", ""]), None),  # missing numbers and texts
    (line(serving=("", "", "")), None),
    (line("X"), "shape"),
    ("", "shape"),
    (None, "shape"),
    (line()[:20], "shape"),
    (line() + ",more", "shape"),
    (line("L") + "|more", "shape"),
    (line("L", basic=BASIC[:6]), "fields"),
    (line("L", serving=("1", "2")), "fields"),
    (line(lists=("11;12", "21", "-81;-82")), "lists"),
    (line("L", lists=("11", "21", "")), "lists"),
    (line(basic=["x", *BASIC[1:]]), "number"),
    (line("L", lists=("11;1x", "21;22", "-81;-82")), "number"),
    (line(serving=("10", "20", "loud")), "number"),
]


def test_shapes(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "row_id long, line string")
    rows = shapes.decode_observations(df).orderBy("row_id").collect()
    assert [(r.reason, r.is_bad) for r in rows] == [(why, why is not None) for _, why in CASES]
    for r, (text, why) in zip(rows, CASES):
        assert r.raw == (text if why else None)
        if why:
            assert r.ts is None and r.sc is None and r.nc is None
    for r in rows[:2]:
        assert {k: r[k] for k in GOOD} == GOOD and tuple(r.sc) == (10, 20, -80.5)
        assert [tuple(x) for x in r.nc] == [(11, 21, -81.5), (12, 22, None)]
    assert rows[2].nc == [] and rows[3].nc == [] and rows[4].ts is None and rows[4].id == ""
    assert shapes.decode_observations(df.limit(0)).count() == 0


def test_a_filter_on_decoded_records_stays_small(spark):
    """Decoding stands in the plan once for the rows and once for a filter, not once for every use of a value."""
    df = spark.createDataFrame([(0, line())], "row_id long, line string").withColumn("line", F.concat("line", F.lit("")))
    out = shapes.decode_observations(df).where("not is_bad").where("ts > 0 and size(nc) > 1").select("row_id", "ts")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("concat(") <= 12 and out.count() == 1


# --- outcomes ---------------------------------------------------------------------------------------


def test_outcomes_add_up(spark, tmp_path):
    obs = spark.createDataFrame(
        [(0, 100_000, 7, 515, None, False, None), (1, 900_000, 7, 515, "own", False, None), (2, None, None, None, None, True, "?"),
         (3, None, None, None, None, None, "??")],
        "row_id long, ts long, mme_ue_s1ap_id long, eci long, id string, is_bad boolean, raw string",
    )
    ref = spark.createDataFrame(
        [(0, "a", 600, 7, 101_000, 102_000)],
        "row_id long, id string, eci long, mme_ue_s1ap_id long, start_ts long, end_ts long",
    )
    path = str(tmp_path / "out")
    jobs.write_outcomes(jobs.backfill_outcomes(obs, ref), path)
    got = spark.read.parquet(path)
    assert sorted((r.row_id, r.outcome, r.id, r.raw) for r in got.collect()) == [
        (0, "filled", "a", None), (1, "unmatched", "own", None), (2, "bad", None, "?"), (3, "bad", None, "??")
    ]
    assert sorted(os.listdir(path))[-3:] == ["outcome=bad", "outcome=filled", "outcome=unmatched"]
    assert jobs.backfill_outcomes(obs, None).groupBy("outcome").count().where("outcome = 'filled'").count() == 0


# --- a decoder as a data source -----------------------------------------------------------------------


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"\n", b"\n\na\n", b"one\ntwo\r\n\nthree", "ä\n日本\nx".encode() * 3])
@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_splits_hold_every_line_once(text, chunk):
    want = [x.removesuffix(b"\r").decode() for x in (text[:-1] if text.endswith(b"\n") else text).split(b"\n")] if text else []
    for size in (1, 2, 5, 100):
        got = []
        for start in range(0, len(text), size):
            for lines in decoded.lines_of(io.BytesIO(text), start, min(start + size, len(text)), 2, chunk):
                assert 0 < len(lines) <= 2
                got += lines
        assert got == want


def test_decoder(spark, tmp_path):
    """Several splits of several files; bad lines are kept as text; folders are columns."""
    rows = [f"{i}\t{1000 + i}\t7\t{'' if i % 5 == 0 else 'view'}\t1\t515\t2\tid{i}" for i in range(100)]
    rows[17], rows[18] = "no record", "1\t2"
    for hour in ("09", "10"):
        folder = tmp_path / "in" / "day=20240115" / f"hour={hour}"
        folder.mkdir(parents=True)
        (folder / "part.txt").write_text("\n".join(rows) + "\n")
        (folder / "_log").write_text("no data")
    read = lambda: decoded.decoded(spark, str(tmp_path / "in"), views.OBS_DECODED, views.decode_lines, splitBytes=500)
    df = read()
    assert df.rdd.getNumPartitions() > 8 and df.count() == 200
    bad = df.where("is_bad and hour = '10'").collect()
    assert len(bad) == 22 and {r.raw for r in bad if r.row_id is None} == {"no record", "1\t2"}
    assert sorted(r.id for r in df.where("hour = '09' and not is_bad").collect()) == sorted(
        f"id{i}" for i in range(100) if i % 5 and i not in (17, 18)
    )
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pruned = read().where("hour = '09'")
        assert pruned.count() == 100 and pruned.rdd.getNumPartitions() <= df.rdd.getNumPartitions() // 2
        assert read().where("hour between '10' and '11' and mme_code = 1").count() == 98
        assert read().where("day = '20240116'").count() == 0
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


# --- counters of a run ----------------------------------------------------------------------------------


@needs_data
def test_counters_of_one_pass(spark, tmp_path):
    """Those of the report, which reads everything again; the run itself reads each raw side once."""
    obs, ref = views.obs_decoded(spark, SF), views.ref_raw(spark, SF)
    out, counters = jobs.counted_backfill(obs, ref, bound=43_200)
    raw = {f for df in (obs, ref) for f in df.inputFiles()}
    assert raw and not raw & set(out.inputFiles())
    out.write.parquet(str(tmp_path / "out"))
    report = jobs.backfill_report(obs, ref, jobs.backfill(obs, ref, bound=43_200)).head().asDict()
    assert {k: v for k, v in report.items() if k != "ratio"} == counters()


def test_counters_of_nothing(spark, tmp_path):
    obs = views.obs_decoded(spark, SF).limit(0) if os.path.isdir(SF) else None
    if obs is None:
        pytest.skip("no test tables")
    out, counters = jobs.counted_backfill(obs, views.ref_raw(spark, SF).limit(0))
    out.write.parquet(str(tmp_path / "out"))
    assert set(counters().values()) == {0}


# --- folders as they are found ----------------------------------------------------------------------------


@pytest.mark.parametrize("nested", [False, True])
def test_missing_hours_are_no_error(spark, tmp_path, nested):
    schema = schemas.struct([("a", "bigint"), ("b", "string")])
    sep = "/" if nested else ""
    for day, hour in (("20240114", "23"), ("20240115", "00"), ("20240115", "05")):
        folder = tmp_path / "in" / f"{day}{sep}{hour}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(f"{hour},x\n")
    read = lambda hour, **kw: folders.read_hours(spark, str(tmp_path / "in"), schema, "20240115", hour, nested=nested, **kw)
    rows = read(0, advance_min=60, later_min=60).collect()
    assert sorted(r.a for r in rows) == [0, 23] and all(r._file.endswith("x.csv") for r in rows)
    assert {r._file.split("/in/")[1] for r in rows} == {f"20240114{sep}23/x.csv", f"20240115{sep}00/x.csv"}
    nothing = read(12)
    assert nothing.count() == 0 and nothing.columns == ["a", "b", "_file"]
    assert folders.read_hours(spark, str(tmp_path / "never"), schema, "20240115", 1).count() == 0

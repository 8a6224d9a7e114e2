"""Every registered query against its SQL, and the shape of the main plans."""

import os
import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from tools.check_oracle import canonical  # noqa: E402

from eventlink.operators.nearest import nearest_join, prev_next  # noqa: E402
from eventlink.operators.sessions import sessionize  # noqa: E402
from eventlink.operators import session_joins  # noqa: E402
from eventlink.plans import jobs, views  # noqa: E402
from eventlink.plans.catalog import QUERIES  # noqa: E402
from eventlink.plans.oracles import ORACLES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    got = canonical(entry.queries()[name](spark, SF).toPandas())
    want = canonical(con.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def plan(spark, df):
    """The physical plan as written, without run-time changes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def count(pattern, text):
    return len(re.findall(pattern, text))


@needs_data
def test_nearest_has_one_plan(spark):
    obs, ref = views.obs(spark, SF), views.ref(spark, SF)
    p = plan(spark, nearest_join(obs, ref, ["k"], 30, ["id"]))
    assert "unboundedfollowing" not in p and "TakeOrdered" not in p and "Generate" not in p and "xxhash64" not in p
    assert "PushedFilters: [In(event_type" in p
    assert all("props" not in x and "value" not in x for x in re.findall(r"ReadSchema: (.*)", p))
    assert plan(spark, nearest_join(obs, ref, ["k"], 30, ["id"])).count("Exchange") == plan(
        spark, nearest_join(obs, ref, ["k"], 10**6, ["id"])
    ).count("Exchange")


SHUFFLE = r"(?<!Broadcast)(?<!Reused)Exchange (?!SinglePartition)"


@needs_data
def test_sessions_are_a_table_and_a_broadcast(spark):
    """The rows are sorted once, before they are written; what is returned only adds the carry."""
    p = plan(spark, sessionize(views.obs(spark, SF), ["k"], gap=30, cap=150))
    # one scan for the rows, the others for the rows of the keys that span ranges
    assert count("Scan parquet", p) <= 3 and count(SHUFFLE, p) <= 4
    rows = p[: p.index("BroadcastExchange")]
    assert "Sort" not in rows and "Window" not in rows and count(SHUFFLE, rows) == 0


@needs_data
@pytest.mark.parametrize(
    "join", ["session_nearest_start", "session_nearest_pair", "session_nearest_dedup", "segment_last_in_window"]
)
def test_session_joins_in_one_pass(spark, join):
    """At most 4 scans and 8 exchanges, broadcasts counted."""
    obs, ref = views.obs(spark, SF).select("row_id", "k", "ts"), views.ref(spark, SF)
    p = plan(spark, getattr(session_joins, join)(obs, ref, ["k"], 3600, ["id"], gap=3600))
    assert "TakeOrdered" not in p and "xxhash64" not in p and "unboundedfollowing, unboundedfollowing" not in p
    assert count("Scan parquet", p) <= 4 and count("Exchange", p) <= 8


def test_a_reference_is_not_copied(spark):
    """However long the bound and however many observations a key has at a time."""
    obs = spark.range(40_000).select(
        F.lit(1).alias("k"), (F.col("id") * 10).alias("ts"), F.col("id").alias("row_id")
    )
    ref = spark.range(2_000).select(
        F.lit(1).alias("k"), (F.col("id") * 200).alias("ts"), F.col("id").alias("row_id"), F.lit("x").alias("id")
    )
    p = plan(spark, nearest_join(obs, ref, ["k"], 43_200, ["id"]))
    assert "Generate" not in p and "Expand" not in p
    assert nearest_join(obs, ref, ["k"], 43_200, ["id"]).where("id is null").count() == 0


def test_one_crowded_instant_is_dealt_out(spark):
    """All rows of a key at one instant: the lookup is made once and joined back to all of them."""
    obs = spark.range(4_000).select(
        F.lit(1).alias("k"), F.lit(100_000).cast("long").alias("ts"), F.col("id").alias("row_id")
    )
    ref = spark.createDataFrame([(1, 101_000, 0, "a")], "k int, ts long, row_id long, id string")
    assert nearest_join(obs, ref, ["k"], 30, ["id"]).where("id = 'a'").count() == 4_000
    look = prev_next(obs, ref, ["k"], ["id"])
    assert look.where("next_id = 'a' and prev_id is null").count() == 4_000


@needs_data
@pytest.mark.parametrize("dropped", jobs.KEYS)
def test_both_key_columns_tell(spark, dropped):
    """Without either of them the composite-key join comes out differently."""
    full = QUERIES["nearest_composite_key"](spark, SF).select("row_id", "ref_row")
    o = jobs.with_site(views.obs_raw(spark, SF))
    r = views.ref_raw(spark, SF).where("mme_ue_s1ap_id <> 4294967295 and eci <> 4294967295 and id <> '\\\\N'")
    rest = [k for k in jobs.KEYS if k != dropped]
    part = nearest_join(
        o, jobs.with_site(r), rest, 43_200, {"ref_row": "row_id"}, ref_time="start_ts", tie="first"
    ).select("row_id", "ref_row")
    assert full.exceptAll(part).count() > 0


@needs_data
def test_report_counts_add_up(spark):
    one = QUERIES["quality_backfill"](spark, SF).head()
    assert one.rows_ok + one.rows_bad == views.obs_raw(spark, SF).count() and one.rows_bad > 0
    assert one.rows_merged <= one.rows_ok
    whole = QUERIES["quality_location"](spark, SF).head()
    assert whole.refs_ok + whole.refs_bad == views.ref_raw(spark, SF).count()

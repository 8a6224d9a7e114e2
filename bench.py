"""Time the headline queries.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventlink.operators.nearest import nearest_join
from eventlink.plans import views
from eventlink.plans.catalog import QUERIES

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "backfill_nearest",
    "backfill_nearest_carry",
    "nearest_range_join",
    "prev_next_ref",
    "sessionize_gap_cap",
    "session_nearest_start",
    "session_nearest_pair",
    "segment_last_in_window",
    "location_nearest",
    "merge_neighbours",
    "merge_neighbours_long",
    "rows_per_key",
    "word_count",
    "quality_backfill",
    "job_backfill",
    "job_backfill_written",
    "job_location",
    "job_chain",
]
WINDOWS = {"1h": 3600, "6h": 6 * 3600, "12h": 12 * 3600, "24h": 24 * 3600}


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn):
    """Best of three."""
    best = None
    for _ in range(3):
        t0 = time.perf_counter()
        run(fn())
        t = time.perf_counter() - t0
        best = t if best is None else min(best, t)
    return round(best, 3)


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    run(views.table(spark, SF, "events").groupBy("user_id").count())

    times = {name: timed(lambda n=name: QUERIES[n](spark, SF)) for name in HEADLINE}

    n_obs, n_ref = views.obs(spark, SF).count(), views.ref(spark, SF).count()
    per_row = {
        name: round((n_obs + n_ref) / times[name])
        for name in ("backfill_nearest", "sessionize_gap_cap", "job_chain")
    }
    fill = {}
    for label, bound in WINDOWS.items():
        out = nearest_join(views.obs(spark, SF), views.ref(spark, SF), ["k"], bound, {"hit": "id"})
        fill[label] = round(out.agg(F.avg(F.col("hit").isNotNull().cast("int"))).head()[0], 4)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": per_row,
                "fill_rate_by_bound": fill,
                "sf": SF.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

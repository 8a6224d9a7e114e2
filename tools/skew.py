"""Time the core operators on a made table in which one key holds a third of the rows.

skew.py FOLDER [MILLIONS] [RUN…]: writes the table to FOLDER once, then times sliced against unsliced
runs (all, or those whose name starts with RUN).
Not part of the registered queries: this only shows how the plans behave under skew.
"""

import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from eventlink.operators.nearest import nearest_join, prev_next  # noqa: E402
from eventlink.operators.session_joins import session_nearest_start  # noqa: E402
from eventlink.operators.sessions import sessionize  # noqa: E402
from eventlink.operators.slicing import Slicing  # noqa: E402

DAYS30_MS = 30 * 86400 * 1000


def make(spark, path, n, seed):
    if os.path.exists(path):
        return
    ids = spark.range(0, n, 1, 16)
    hot = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3)) == 0
    key = F.when(hot, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(200_000)))
    ts = F.lit(1704067200000) + F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(DAYS30_MS))
    ids.select(
        F.col("id").alias("row_id"),
        key.alias("k"),
        ts.alias("ts"),
        F.concat(F.lit("id"), F.col("id")).alias("id"),
    ).write.parquet(path)


def main(folder, millions, only):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.local.dir", f"{folder}/local")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    n = millions * 1_000_000
    make(spark, f"{folder}/obs{millions}", n, 1)
    make(spark, f"{folder}/ref{millions}", n // 2, 10)
    obs = spark.read.parquet(f"{folder}/obs{millions}").withColumnRenamed("id", "own")
    ref = spark.read.parquet(f"{folder}/ref{millions}")
    whole = Slicing(width=10**16)
    runs = {
        "nearest 30s, slices": lambda: nearest_join(obs, ref, ["k"], 30, ["id"]),
        "nearest 30s, one slice per key": lambda: nearest_join(obs, ref, ["k"], 30, ["id"], slicing=whole),
        "nearest 12h, slices": lambda: nearest_join(obs, ref, ["k"], 43200, ["id"]),
        "nearest 12h, one slice per key": lambda: nearest_join(obs, ref, ["k"], 43200, ["id"], slicing=whole),
        "prev/next, slices": lambda: prev_next(obs, ref, ["k"], ["id"]),
        "sessions, ranges": lambda: sessionize(obs, ["k"], gap=30, cap=150),
        "session start, ranges": lambda: session_nearest_start(obs, ref, ["k"], 30, ["id"]),
    }
    nearest_join(obs.where("k = 7"), ref.where("k = 7"), ["k"], 30, ["id"]).count()  # warm up
    for name, run in runs.items():
        if not name.startswith(tuple(only)):
            continue
        t0 = time.time()
        df = run()
        sums = {}
        for c in ("id", "session_seq", "prev_id"):
            if c in df.columns:
                sums[c] = F.sum(F.xxhash64("row_id", c).cast("decimal(38,0)"))
        out = df.agg(*[v.alias(c) for c, v in sums.items()], F.count(F.lit(1)).alias("n")).head()
        print(f"\r{name:34s} {time.time() - t0:7.1f}s  {out.asDict()}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 10, sys.argv[3:] or [""])

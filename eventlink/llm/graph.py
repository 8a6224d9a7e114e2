"""Connected components by smallest labels, with short cuts, over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlink.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of ``links``: label is the smallest node that it is connected with.

    Each round a node takes the smallest label around it and then its label's label, so that chains shorten
    fast.  Labels are a written table after each round; only the number of changes comes to the driver.
    Nulls link nothing; no links give no rows.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = saved(links.union(links.select("b", "a")).distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("least"))
        near = labels.join(around, F.col("node") == F.col("a"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        up = labels.select(F.col("node").alias("n"), F.col("label").alias("up"))
        new = near.join(up, F.col("label") == F.col("n"), "left").select("node", "old", F.least("label", "up").alias("label"))
        new = saved(new, "labels")
        changed = new.where(F.col("label") != F.col("old")).limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after further ``links`` (a, b) between the components that ``labels`` holds.

    The links shrink to one for each two components before anything spreads over them.  A node without a label so
    far is a component of its own.  Labels stay the smallest node of each component.
    """
    ends = saved(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    new = ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    all_ = saved(labels.unionByName(new), "labels")
    la, lb = (all_.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    between = links.join(la, "a").join(lb, "b").where("la <> lb")
    between = between.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
    up = components(between).select(F.col("node").alias("label"), F.col("label").alias("up"))
    return saved(all_.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")

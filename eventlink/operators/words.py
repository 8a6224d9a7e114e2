"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the separators are space, tab, newline, carriage return and form feed, nothing else.
SEPARATORS = "[ \t\n\r\f]+"


def word_count(df: DataFrame, text: str) -> DataFrame:
    words = df.select(F.explode(F.split(F.col(text), SEPARATORS)).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_totals(counts: DataFrame) -> DataFrame:
    """Words read and distinct words written."""
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("words"),
        F.count(F.lit(1)).alias("distinct_words"),
    )

"""Word count as a DataFrame job: split -> explode -> partial aggregate ->
shuffle by word -> final aggregate (the ``reduceByKey`` map-side combine)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions import tokens


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) for every token of every text, split on single spaces with
    the JVM's trailing-empty rule. Each text is processed whole; hot words
    shrink to one partial row per task before the shuffle."""
    words = df.select(F.explode(tokens(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))

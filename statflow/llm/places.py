"""Running totals within keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir

#: Hash ranges of a key per shuffle partition.
RANGES_PER_PARTITION = 4
_H, _R = "_place_hash", "_place_range"


def place_ranges(df: DataFrame, key: list[str], order_hash: Column, value: Column,
                 totals: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Split every key into equal ranges of a 64-bit hash.

    Returns ``df`` with the hash and its range, and a checkpointed table with
    one row per key and range: ``_range_total`` (sum of ``value``) and
    ``_range_before`` (sum over the key's earlier ranges). Sums are made
    before the shuffle, and the window over a key reads one row per range.
    Without ``totals`` only the first is made.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = RANGES_PER_PARTITION * max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    step = (1 << 64) // ranges + 1
    # the hash as a fraction of its domain; ranges follow the hash's order
    at = F.floor((F.col(_H).cast("double") + F.lit(2.0 ** 63)) / F.lit(float(step))).cast("int")
    marked = df.withColumn(_H, order_hash).withColumn(_R, at)
    if not totals:
        return marked, None
    sums = marked.groupBy(*key, _R).agg(F.sum(value).alias("_range_total"))
    before = Window.partitionBy(*key).orderBy(_R).rowsBetween(Window.unboundedPreceding, -1)
    return marked, sums.withColumn(
        "_range_before", F.coalesce(F.sum("_range_total").over(before), F.lit(0))).checkpoint()


def place_rows(marked: DataFrame, ranges: DataFrame, key: list[str], ties: list[str],
               value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the key's rows with a smaller
    (hash, ``ties``). Rows shuffle once, by key and range."""
    inner = (Window.partitionBy(*key, _R).orderBy(_H, *ties)
             .rowsBetween(Window.unboundedPreceding, -1))
    local = marked.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (local.join(ranges, [*key, _R])
            .withColumn(name, F.col(name) + F.col("_range_before"))
            .drop(_H, _R, "_range_total", "_range_before"))

"""Running totals in one global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir

_PART = "_ordered_part"
_BASE = "_ordered_base_"


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """``df`` plus, per entry of ``totals``, the sum of its expression over all
    rows that stand before the row in ``order`` (the row itself excluded).

    The rows are range-partitioned by ``order``; each partition's sums become
    the offsets of the later ones, so no task reads more than one partition
    (the offsets are one row per partition). The range-partitioned rows are
    checkpointed in the shared folder: both passes then see one and the same
    partitioning, also when an executor is lost. ``order`` should be unique;
    tied rows get their places in any order. NULL summands count as 0, an
    empty input gives an empty result.
    """
    ensure_checkpoint_dir(df.sparkSession)
    base = df.select("*", *[F.coalesce(e, F.lit(0)).alias(_BASE + n) for n, e in totals.items()])
    parts = base.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id()).checkpoint()
    sums = parts.groupBy(_PART).agg(*[F.sum(_BASE + n).alias(n) for n in totals])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(_PART, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_off" + n)
                                   for n in totals])
    inner = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(offsets), _PART)  # one row per partition
    for n in totals:
        out = out.withColumn(n, F.col("_off" + n) + F.coalesce(F.sum(_BASE + n).over(inner), F.lit(0)))
    return out.drop(_PART, *[_BASE + n for n in totals], *["_off" + n for n in totals])

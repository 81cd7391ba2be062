"""What changed between two snapshots of a keyed table.

Both snapshots are reduced to one row per key: the number of its rows and two
order-free sums of 64-bit row hashes (other seeds), made before the shuffle.
One full outer join of these tells which keys are new, gone or different; only
their rows are read again. So an unchanged table costs its keys and hashes, not
its rows, and a key with many rows is one row there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
INSERT, UPDATE, DELETE = "insert", "update", "delete"
# Private names of the join.
_OLD, _NEW = "_changes_old", "_changes_new"


def _hash(df: DataFrame, seed: int) -> Column:
    """A hash of the whole row that tells NULLs, empty strings and neighbours
    apart."""
    cells = []
    for c in df.columns:
        cells += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`")]
    return F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)")


def key_prints(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """One row per key: ``name`` (row count and sums of row hashes)."""
    return df.groupBy(*key).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(_hash(df, 1)).alias("a"),
                                         F.sum(_hash(df, 2)).alias("b")).alias(name))


def changed_keys(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that differ, with ``change``. NULL keys are keys like others."""
    left, right = key_prints(old, key, _OLD), key_prints(new.select(*old.columns), key, _NEW)
    right = right.select(*[F.col(f"`{k}`").alias(f"_changes_{i}") for i, k in enumerate(key)], _NEW)
    on = [left[k].eqNullSafe(F.col(f"_changes_{i}")) for i, k in enumerate(key)]
    both = left.join(right, on, "full")
    change = (F.when(F.col(_OLD).isNull(), INSERT).when(F.col(_NEW).isNull(), DELETE)
              .when(F.col(_OLD) != F.col(_NEW), UPDATE))
    names = [F.when(F.col(_OLD).isNull(), F.col(f"_changes_{i}")).otherwise(left[k]).alias(k)
             for i, k in enumerate(key)]
    return both.select(*names, change.alias(CHANGE)).filter(F.col(CHANGE).isNotNull())


def _matching(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    on = [df[k].eqNullSafe(keys[k]) for k in key]
    joined = df.alias("_d").join(keys.alias("_k"), on, how)
    if how != "inner":
        return joined
    return joined.select(*[df[c] for c in df.columns], keys[CHANGE])


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that turn ``old`` into ``new``: all rows of ``new`` whose key is
    new (``insert``) or has other rows than before (``update``), and one row per
    key that is gone (``delete``; only its key is set), told by ``change``.

    Both tables have the same columns (in any order) and are read twice;
    checkpoint what is costly or not repeatable. Rows of one key are a bag:
    if anything in it differs, all of its new rows are there."""
    if set(old.columns) != set(new.columns) or CHANGE in old.columns or not key:
        raise ValueError(f"snapshots need equal columns without {CHANGE!r}, and a key")
    keys = changed_keys(old, new, key)
    fresh = new.select(*[F.col(f"`{c}`") for c in old.columns])
    written = _matching(fresh, keys.filter(F.col(CHANGE) != DELETE), key, "inner")
    gone = keys.filter(F.col(CHANGE) == DELETE).select(
        *[F.col(f"`{c}`") if c in key else F.lit(None).cast(old.schema[c].dataType).alias(c)
          for c in old.columns], CHANGE)
    return written.unionByName(gone)


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``old`` after ``changes``: the rows of untouched keys, and the written
    rows."""
    touched = changes.select(*key).distinct()
    kept = _matching(old, touched, key, "left_anti")
    return kept.unionByName(changes.filter(F.col(CHANGE) != DELETE).drop(CHANGE))

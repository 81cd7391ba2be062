"""Relating tables: inner join, semi-join reduction, lookups with a default,
distinct keys and counts.

Nothing reaches the driver. Join strategy is left to Catalyst/AQE (broadcast
when a side is small at runtime, sort-merge otherwise, skew splitting for hot
keys); the one explicit broadcast is the list of heavy keys, of which there
are at most as many as shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from statflow.functions._col import as_col

_SALT = "__salt"


def inner_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], salt: int | str = 1
) -> DataFrame:
    """Using-column inner equi-join: key columns once and first, NULL keys
    never match, duplicate keys fan out.

    ``salt="auto"``, or a number of buckets above 1, splits the heavy keys of
    either side (:func:`skew_join`). Without it, AQE's skew handling splits
    oversized sort-merge partitions at runtime.
    """
    if salt == 1:
        return left.join(right, on=on, how="inner")
    if not isinstance(on, str):
        raise ValueError("a salted join needs a single join column")
    return skew_join(left, right, on, "inner", buckets=None if salt == "auto" else int(salt))


def semi_reduce(
    df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None, salt: int | str = 1
) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``keys`` (left-semi join).

    Replaces collect-keys-then-``isin``: no driver round trip, no literal list
    that grows with the data. Keys are de-duplicated with a partial
    (map-side) aggregate first, so a hot key costs one row per partition,
    and AQE broadcasts the distinct keys when they turn out small. NULL keys
    drop on both sides; an empty key set gives no rows. ``salt`` splits the
    heavy keys of ``df`` as in :func:`inner_join`.
    """
    keys_key = keys_key or key
    k = keys.select(F.col(keys_key).alias(key)).distinct()
    if salt == 1:
        return df.join(k, on=key, how="left_semi")
    return skew_join(df, k, key, "left_semi", buckets=None if salt == "auto" else int(salt))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    keyed = df.filter(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))


def _keyed_rows(df: DataFrame, key: str) -> Column:
    """The number of rows with a key, as a scalar subquery."""
    return df.agg(F.count(F.col(key)).alias("__rows")).scalar()


def heavy_keys(df: DataFrame, key: str, min_share: float | None = None) -> DataFrame:
    """One row (``key``) per key holding at least ``min_share`` of the rows
    with a key, by default the share of one shuffle partition: a key above it
    makes its partition larger than a fair one. At most ``1 / min_share``
    keys qualify, whatever the table size. Lazy: one partial+final aggregate
    over the key column.
    """
    least = _keyed_rows(df, key) * _share(df, min_share)
    return _key_counts(df, key).filter(F.col("__n") >= least).select(key)


def _share(df: DataFrame, min_share: float | None) -> float:
    share = 1 / _partitions(df) if min_share is None else min_share
    if not 0 < share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    return share


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    buckets: int | None = None,
    min_share: float | None = None,
) -> DataFrame:
    """Equi-join (``inner`` or ``left_semi``) on one column that splits only
    the heavy keys into ``buckets`` salted sub-keys. A key is heavy that holds
    ``min_share`` of the larger table's rows (by default a shuffle partition's
    share, see :func:`heavy_keys`) on either side. The side that holds more of
    it has its rows dealt out, the other's are copied to every bucket; other
    keys join as usual. ``buckets`` defaults to the shuffle partitions. Nothing
    runs before the result is asked for. Results equal the plain join."""
    if how not in ("inner", "left_semi"):
        raise ValueError("skew_join supports inner and left_semi")
    if how == "left_semi":
        right = right.select(key).distinct()
    buckets = buckets or _partitions(left)
    share = _share(left, min_share)
    if how == "left_semi":
        heavy = _key_counts(left, key).filter(F.col("__n") >= _keyed_rows(left, key) * share)
        hot = heavy.select(key, F.lit("l").alias("__side"))
    else:
        least = F.greatest(_keyed_rows(left, key), _keyed_rows(right, key)) * share
        sides = [_key_counts(df, key).filter(F.col("__n") >= least).withColumn("__side", F.lit(side))
                 for df, side in ((left, "l"), (right, "r"))]
        hot = sides[0].unionByName(sides[1]).groupBy(key).agg(F.max_by("__side", "__n").alias("__side"))

    def salted(df: DataFrame, own: str) -> DataFrame:
        row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(buckets)).cast("int")
        every = F.sequence(F.lit(0), F.lit(buckets - 1))
        places = (F.when(F.col("__side") == own, F.array(row))
                  .when(F.col("__side").isNotNull(), every).otherwise(F.array(F.lit(0))))
        marked = df.join(F.broadcast(hot), key, "left")  # at most 2 / min_share rows
        return marked.select(*[marked[c] for c in df.columns], F.explode(places).alias(_SALT))

    return salted(left, "l").join(salted(right, "r"), on=[key, _SALT], how=how).drop(_SALT)


def isin_filter(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Membership test against a short literal list (pushed to the scan)."""
    return df.filter(F.col(key).isin(list(values)))


def map_lookup(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Code -> name through a fixed map; unmapped codes map to themselves and
    NULL stays NULL. The map is a literal inside the generated code."""
    key = as_col(c)
    if not mapping:
        return key
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, key), key)


def lookup_udf(mapping: Mapping[str, str]):
    """Vectorised (Arrow) twin of :func:`map_lookup`, the UDF surface of the
    original job; the mapping travels with the function closure."""
    table = dict(mapping)

    @F.pandas_udf(StringType())
    def _lookup(codes: pd.Series) -> pd.Series:
        return codes.map(table).where(codes.isin(table.keys()), codes)

    return _lookup


def lookup_or_self(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    out: str | None = None,
) -> DataFrame:
    """Table-driven lookup with default: ``out`` = the dimension value for
    ``key``, or ``key`` itself when absent. The dimension is reduced to one
    value per key (the largest, so the result is deterministic); Spark
    chooses the join by its measured size."""
    out = out or key
    d = dim.groupBy(F.col(dim_key).alias("__k")).agg(F.max(dim_value).alias("__v"))
    joined = df.join(d, F.col(key) == F.col("__k"), "left")
    cols = [c for c in df.columns if c != out] if out != key else df.columns
    result = [
        F.coalesce(F.col("__v"), F.col(key)).alias(out) if c == out else F.col(f"`{c}`")
        for c in cols
    ]
    if out != key:
        result.append(F.coalesce(F.col("__v"), F.col(key)).alias(out))
    return joined.select(*result)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))

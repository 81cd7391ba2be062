"""Balanced parallel reads of JDBC tables.

Spark cuts a numeric key's span into even strides; ids cluster, so most rows
may fall into one of them, and string ids cannot be cut at all. Here the cuts
are quantiles of a sample of the key: one pass over the key column keeps a
bounded uniform sample (the rows with the smallest seeded hashes), the database
puts the sampled keys in its own order (a collation may differ from Spark's),
and every cut has equally many sampled keys before it. Ranges are closed below
and open above in the database's order, so each row is in exactly one, whatever
the sample; NULL keys are in the first.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.sources.jdbc import read_table
from statflow.sources.jdbc_once import transaction

#: Sampled keys per partition; a range's share of the rows is then within some
#: 30 % of the mean (three standard deviations).
KEYS_PER_PARTITION = 100
#: Keys named in one statement.
KEYS_PER_STATEMENT = 500


def literal(value: object) -> str:
    """A key value as SQL."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"not a key value: {value!r}")
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"  # JDBC's escapes
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"not a key value: {value!r}")


def sample_keys(keys: DataFrame, most: int) -> list:
    """A uniform sample of at most ``most`` of the values of a one-column
    table (NULLs left out), kept while the column streams by."""
    name = keys.columns[0]
    known = keys.filter(F.col(f"`{name}`").isNotNull())
    # the place in the stream tells equal keys apart; the k smallest hashes of
    # every task, then of all (TakeOrderedAndProject)
    drawn = F.xxhash64(F.lit(42), F.monotonically_increasing_id())
    rows = known.select(F.col(f"`{name}`").alias("k"), drawn.alias("h")).orderBy("h").limit(most).collect()
    return [r["k"] for r in rows]


def _in_database_order(spark: SparkSession, url: str, table: str, column: str, values: list,
                       **login: str | None) -> list:
    """Key values in the database's order: it sorts each statement's list, and
    a value's place in the whole is merged from its places among the values of
    every other list."""
    names = {literal(v): v for v in values}
    texts = list(names)
    with transaction(spark, url, **login) as c:
        sign = c.getMetaData().getIdentifierQuoteString().strip()
        key = f"{sign}{column}{sign}"

        def ordered(own: list[str]) -> list:
            statement = c.createStatement()
            try:
                rows = statement.executeQuery(f"SELECT DISTINCT {key} FROM {table} WHERE {key} IN "
                                              f"({', '.join(own)}) ORDER BY 1")
                out = []
                while rows.next():
                    out.append(rows.getString(1))
                return out
            finally:
                statement.close()

        by_text = {str(v): v for v in values}
        runs = [ordered(texts[i:i + KEYS_PER_STATEMENT // 2])
                for i in range(0, len(texts), KEYS_PER_STATEMENT // 2)]
        while len(runs) > 1:  # merge neighbours, block by block
            runs = [_merge(a, b, lambda own: ordered([literal(by_text[t]) for t in own]))
                    for a, b in zip(runs[::2], [*runs[1::2], *[[]] * (len(runs) % 2)])]
    return [by_text[t] for t in runs[0]] if runs else []


def _merge(a: list[str], b: list[str], ordered) -> list[str]:
    """Two ordered lists as one; ``ordered`` sorts a list of bounded size."""
    half, out = KEYS_PER_STATEMENT // 2, []
    while a and b:
        both = ordered(a[:half] + b[:half])
        # sure up to where one of the two blocks ends
        ends = {a[:half][-1], b[:half][-1]}
        upto = next(k for k, t in enumerate(both) if t in ends) + 1
        sure = set(both[:upto])
        out += both[:upto]
        a, b = [t for t in a if t not in sure], [t for t in b if t not in sure]
    return out + a + b


def split_points(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                 keys_per_partition: int = KEYS_PER_PARTITION, **login: str | None) -> list:
    """At most ``num_partitions - 1`` different key values, in the database's
    order, that cut the table into parts of nearly equal size."""
    keys = read_table(spark, url, table, **login).select(F.col(f"`{column}`"))
    sampled = Counter(sample_keys(keys, num_partitions * keys_per_partition))
    if not sampled:
        return []
    total, before, cuts = sum(sampled.values()), 0, []
    for value in _in_database_order(spark, url, table, column, list(sampled), **login):
        # a cut where the keys before fill one more part
        if before and before * num_partitions // total > len(cuts):
            cuts += [value] * (before * num_partitions // total - len(cuts))
        before += sampled[value]
    return list(dict.fromkeys(cuts))


def range_predicates(column: str, cuts: list, sign: str = '"') -> list[str]:
    """One condition per range; together they hold for every row once."""
    key = f"{sign}{column}{sign}"
    if not cuts:
        return ["1 = 1"]
    texts = [literal(c) for c in cuts]
    return [f"({key} < {texts[0]} OR {key} IS NULL)",
            *[f"({key} >= {a} AND {key} < {b})" for a, b in zip(texts, texts[1:])], f"{key} >= {texts[-1]}"]


def read_table_balanced(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                        user: str | None = None, password: str | None = None,
                        driver: str | None = None) -> DataFrame:
    """A JDBC table read by ``num_partitions`` range queries of nearly equal
    size on ``column`` (numbers, strings, dates). A value that holds more rows
    than a part has a range of its own."""
    login = {"user": user, "password": password, "driver": driver}
    cuts = split_points(spark, url, table, column, num_partitions, **login)
    with transaction(spark, url, **login) as c:
        sign = c.getMetaData().getIdentifierQuoteString().strip()
    properties = {k: v for k, v in login.items() if v is not None}
    return spark.read.jdbc(url, table, predicates=range_predicates(column, cuts, sign), properties=properties)

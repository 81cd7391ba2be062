"""JDBC tables: overwrite sink and read-back source.

Credentials are parameters (never literals in code); parallelism and batch
size are exposed so a large table is written by many tasks in batches
instead of one connection per default partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(url: str, table: str, user: str | None, password: str | None,
             driver: str | None, extra: dict) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    mode: str = "overwrite",
    driver: str | None = None,
    num_partitions: int | None = None,
    batchsize: int | None = None,
    truncate: bool | None = None,
    column_types: str | None = None,
) -> None:
    """Overwrite (default) a JDBC table with ``df``.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it),
    ``truncate`` keeps the table definition on overwrite, ``column_types``
    (``"ID VARCHAR(64)"``) names database types for a table that is made.
    """
    extra = {"numPartitions": num_partitions, "batchsize": batchsize,
             "createTableColumnTypes": column_types,
             "truncate": None if truncate is None else str(truncate).lower()}
    df.write.format("jdbc").options(**_options(url, table, user, password, driver, extra)).mode(
        mode
    ).save()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a JDBC table; give a numeric ``partition_column`` and bounds to
    read it with ``num_partitions`` parallel range queries."""
    extra = {}
    if partition_column is not None:
        extra = {"partitionColumn": partition_column, "lowerBound": lower_bound,
                 "upperBound": upper_bound, "numPartitions": num_partitions}
    return spark.read.format("jdbc").options(
        **_options(url, table, user, password, driver, extra)
    ).load()

"""JDBC tables that hold each row once, whatever tasks or drivers fail.

Spark inserts a partition in one transaction, but a partition may be inserted
twice (a speculative attempt, a retry after a lost executor) and a job that
fails leaves what other partitions had committed. Here the rows first go to a
staging table of the run. Every row carries its partition and the attempt that
wrote it, and every attempt adds, in the same transaction, one ledger row with
the number of its rows: an attempt is either whole and in the ledger or not
there at all. When Spark's job is done, one database transaction takes one
attempt of each partition, the first in the ledger, checks that its rows are as
many as the ledger says, replaces the target's rows (or those of the changed
keys, or adds to them) and records run and partitions in a ledger table whose
primary key is (run, partition). Readers see the old table or the new one; a
run that is published again, after a driver that failed, changes nothing.

The transaction is SQL that the database runs on its own tables; no row passes
through the driver.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from statflow.operators.changes import CHANGE, DELETE
from statflow.session import ensure_checkpoint_dir
from statflow.sources.jdbc import write_table

LEDGER = "statflow_ledger"
_PART, _ATTEMPT, _ROWS = "statflow_part", "statflow_attempt", "statflow_rows"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def tagged(df: DataFrame) -> DataFrame:
    """``df`` with partition and attempt of every row, and a ledger row at the
    end of each partition (also of an empty one)."""
    schema = StructType([*(StructField(f.name, f.dataType, True) for f in df.schema),
                         StructField(_PART, IntegerType()), StructField(_ATTEMPT, LongType()),
                         StructField(_ROWS, LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from pyspark.sql.pandas.types import to_arrow_schema

        task = TaskContext.get()
        part, attempt, rows = task.partitionId(), task.taskAttemptId(), 0
        arrow = to_arrow_schema(schema)

        def batch_of(columns: list, n: int, marker: int | None) -> pa.RecordBatch:
            tags = [pa.array([v] * n, t) for v, t in
                    ((part, pa.int32()), (attempt, pa.int64()), (marker, pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, *tags], names=arrow.names)

        for batch in batches:
            rows += batch.num_rows
            yield batch_of(batch.columns, batch.num_rows, None)
        # empty strings, since some drivers refuse a NULL for a string key's type
        blank = [pa.array([""]) if pa.types.is_string(f.type) else pa.nulls(1, f.type)
                 for f in list(arrow)[:-3]]
        yield batch_of(blank, 1, rows)

    return df.mapInArrow(run, schema)


@contextmanager
def transaction(spark: SparkSession, url: str, user: str | None = None, password: str | None = None,
                driver: str | None = None):
    """A database connection of the driver, committed at the end or rolled
    back."""
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    options = jvm.java.util.Properties()
    for name, value in (("user", user), ("password", password)):
        if value is not None:
            options.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, options)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(connection, sql: str) -> int:
    statement = connection.createStatement()
    try:
        return statement.executeUpdate(sql)
    finally:
        statement.close()


def _number(connection, sql: str) -> int:
    statement = connection.createStatement()
    try:
        rows = statement.executeQuery(sql)
        rows.next()
        return rows.getLong(1)
    finally:
        statement.close()


def _has_table(connection, table: str) -> bool:
    schema, _, name = table.rpartition(".")
    for n in {name, name.upper(), name.lower()}:
        for s in {schema or None, schema.upper() or None, schema.lower() or None}:
            if connection.getMetaData().getTables(None, s, n, None).next():
                return True
    return False


def stage(df: DataFrame, url: str, staging: str, num_partitions: int | None = None,
          batchsize: int | None = None, column_types: str | None = None, **login: str | None) -> None:
    """Adds ``df``'s partitions to the staging table (made if absent). May be
    repeated, also after a failure."""
    write_table(tagged(df), url, staging, mode="append", num_partitions=num_partitions,
                batchsize=batchsize, column_types=column_types, **login)


def publish(spark: SparkSession, url: str, table: str, staging: str, run: str, columns: Sequence[str],
            partitions: int, mode: str = "overwrite", key: Sequence[str] = (), **login: str | None) -> int:
    """One transaction: the first whole attempt of each of the ``partitions``
    becomes part of ``table``. Returns the number of rows; -1 if the run had
    been published before."""
    with transaction(spark, url, **login) as c:
        if not _has_table(c, LEDGER):
            _execute(c, f"CREATE TABLE {LEDGER} (run VARCHAR(64) NOT NULL, part INTEGER NOT NULL, "
                        "attempt BIGINT, row_count BIGINT, PRIMARY KEY (run, part))")
    with transaction(spark, url, **login) as c:
        sign = c.getMetaData().getIdentifierQuoteString().strip()

        def quoted(name: str, of: str = "") -> str:
            return f"{of}{sign}{name.replace(sign, sign * 2) if sign else name}{sign}"

        if _number(c, f"SELECT COUNT(*) FROM {LEDGER} WHERE run = '{run}'"):
            return -1
        part, attempt, rows = (quoted(n) for n in (_PART, _ATTEMPT, _ROWS))
        chosen = (f"(SELECT {part} AS p, MIN({attempt}) AS a FROM {staging} "
                  f"WHERE {rows} IS NOT NULL GROUP BY {part}) c")
        of = f"s.{part} = c.p AND s.{attempt} = c.a"
        _execute(c, f"INSERT INTO {LEDGER} (run, part, attempt, row_count) SELECT '{run}', c.p, c.a, s.{rows} "
                    f"FROM {staging} s JOIN {chosen} ON {of} WHERE s.{rows} IS NOT NULL")
        own = f"{staging} s JOIN {chosen} ON {of} WHERE s.{rows} IS NULL"
        there = _number(c, f"SELECT COUNT(*) FROM {own}")
        told = _number(c, f"SELECT COALESCE(SUM(row_count), 0) FROM {LEDGER} WHERE run = '{run}'")
        parts = _number(c, f"SELECT COUNT(*) FROM {LEDGER} WHERE run = '{run}'")
        if there != told or parts != partitions:
            raise RuntimeError(f"{staging}: {there} of {told} rows, {parts} of {partitions} partitions")
        if mode == "overwrite":
            _execute(c, f"DELETE FROM {table}")
        elif mode == "changes":
            same = " AND ".join(f"s.{quoted(k)} = {table}.{quoted(k)}" for k in key)
            _execute(c, f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {own} AND {same})")
            own += f" AND s.{quoted(CHANGE)} <> '{DELETE}'"
        _execute(c, f"INSERT INTO {table} ({', '.join(quoted(n) for n in columns)}) "
                    f"SELECT {', '.join(quoted(n, 's.') for n in columns)} FROM {own}")
        return there


def write_table_once(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    mode: str = "overwrite",
    key: Sequence[str] = (),
    num_partitions: int | None = None,
    batchsize: int | None = None,
    run: str | None = None,
    column_types: str | None = None,
) -> int:
    """Write ``df`` so that the table holds each of its rows once. ``mode``:
    ``overwrite`` (the table's rows are replaced; its columns stay),
    ``append``, or ``changes`` (``df`` is a table of
    :func:`statflow.operators.changes.snapshot_changes`: rows of its ``key``
    values are replaced or deleted). ``run`` names the run; a repeated run that
    was published before changes nothing. The rows are checkpointed first, so
    that every attempt of a partition writes the same ones. ``column_types``:
    database types of a table that is made, such as ``"ID VARCHAR(64)"`` where
    the database cannot compare its default type for strings (key columns)."""
    if mode not in ("overwrite", "append", "changes") or (mode == "changes") != bool(key):
        raise ValueError("mode is overwrite, append, or changes with a key")
    if not _NAME.fullmatch(table):
        raise ValueError(f"not a plain table name: {table!r}")
    run = run or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_]{1,40}", run):
        raise ValueError("a run's name is of letters, digits and _")
    login = {"user": user, "password": password, "driver": driver}
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    fixed = df.checkpoint()
    columns = [c for c in df.columns if not (mode == "changes" and c == CHANGE)]
    write_table(fixed.select(*columns).limit(0), url, table, mode="append", column_types=column_types,
                **login)  # made if absent
    staging = f"{table}_stage_{run}"
    if mode == "changes":
        column_types = ", ".join(filter(None, [column_types, f"{CHANGE} VARCHAR(16)"]))
    stage(fixed, url, staging, num_partitions, batchsize, column_types, **login)
    rows = publish(spark, url, table, staging, run, columns, fixed.rdd.getNumPartitions(), mode, key, **login)
    with transaction(spark, url, **login) as c:  # a late attempt then finds no table to write to
        _execute(c, f"DROP TABLE {staging}")
    return rows


# The tagging function goes to the Python workers with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["publish", "stage", "tagged", "transaction", "write_table_once"]

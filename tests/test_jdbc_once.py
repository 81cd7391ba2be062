"""Exactly-once JDBC tables on embedded in-memory Derby (no server, no port)."""

import os
import subprocess
import sys
import textwrap

import pytest

from statflow.operators.changes import snapshot_changes
from statflow.sources import jdbc_once as J
from statflow.sources import read_table

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def url(name):
    return f"jdbc:derby:memory:{name};create=true"


def rows(spark, u, table):
    return sorted(tuple(r) for r in read_table(spark, u, table, driver=DRIVER).collect())


def frame(spark, values):
    return spark.createDataFrame(values, "ID string, V int, D double").repartition(4, "ID")


def test_overwrite_append_and_repeated_runs(spark):
    u = url("once_modes")
    first = [(f"a{i}", i, i / 2) for i in range(50)] + [("a1", 1, 0.5)]  # a repeated row stays twice
    assert J.write_table_once(frame(spark, first), u, "T", driver=DRIVER) == 51
    assert rows(spark, u, "T") == sorted(first)
    second = [("b", 1, None), (None, None, 2.0)]
    J.write_table_once(frame(spark, second), u, "T", driver=DRIVER, run="r2")
    J.write_table_once(frame(spark, first), u, "T", driver=DRIVER, mode="append", run="r3")
    want = sorted(map(str, first + second))
    assert sorted(map(str, rows_any(spark, u))) == want
    assert J.write_table_once(frame(spark, first), u, "T", driver=DRIVER, mode="append", run="r3") == -1
    assert sorted(map(str, rows_any(spark, u))) == want
    empty = frame(spark, first).filter("ID = 'none'")
    assert J.write_table_once(empty, u, "T", driver=DRIVER) == 0
    assert rows_any(spark, u) == []


def rows_any(spark, u, table="T"):
    return [tuple(r) for r in read_table(spark, u, table, driver=DRIVER).collect()]


def test_duplicated_attempts_give_each_row_once(spark):
    """Every partition is committed twice, as speculation may do."""
    u = url("once_twice")
    data = frame(spark, [(f"a{i}", i, None) for i in range(40)]).checkpoint()
    J.write_table_once(data.limit(0), u, "T", driver=DRIVER)
    for _ in range(2):
        J.stage(data, u, "T_stage_x", driver=DRIVER)
    assert read_table(spark, u, "T_stage_x", driver=DRIVER).count() == 2 * (40 + data.rdd.getNumPartitions())
    J.publish(spark, u, "T", "T_stage_x", "x", data.columns, data.rdd.getNumPartitions(), driver=DRIVER)
    assert sorted(rows_any(spark, u)) == sorted(tuple(r) for r in data.collect())


def test_a_missing_partition_or_row_leaves_the_old_table(spark):
    u = url("once_missing")
    old = [("old", 1, 1.0)]
    J.write_table_once(frame(spark, old), u, "T", driver=DRIVER)
    data = frame(spark, [(f"a{i}", i, None) for i in range(40)]).checkpoint()
    n = data.rdd.getNumPartitions()
    J.stage(data, u, "T_stage_x", driver=DRIVER)
    with pytest.raises(RuntimeError):
        J.publish(spark, u, "T", "T_stage_x", "x", data.columns, n + 1, driver=DRIVER)
    with J.transaction(spark, u, driver=DRIVER) as c:
        J._execute(c, "DELETE FROM T_stage_x WHERE \"V\" = 7")
    with pytest.raises(RuntimeError):
        J.publish(spark, u, "T", "T_stage_x", "x", data.columns, n, driver=DRIVER)
    assert rows_any(spark, u) == old
    J.stage(data, u, "T_stage_y", driver=DRIVER)  # another run
    assert J.publish(spark, u, "T", "T_stage_y", "y", data.columns, n, driver=DRIVER) == 40


def test_changes_equal_the_overwrite(spark):
    u = url("once_changes")
    old = [(f"a{i}", i, i / 2) for i in range(30)] + [("two", 1, 0.0), ("two", 2, 0.0)]
    new = [(f"a{i}", i + (i % 5 == 0), i / 2) for i in range(10, 40)] + [("two", 1, 0.0)]
    J.write_table_once(frame(spark, old), u, "T", driver=DRIVER, column_types="ID VARCHAR(40)")
    changes = snapshot_changes(frame(spark, old), frame(spark, new), ["ID"])
    assert changes.count() == 10 + 4 + 10 + 1  # gone, other (a10, a15, a20, a25), new, the pair's rest
    J.write_table_once(changes, u, "T", driver=DRIVER, mode="changes", key=["ID"], column_types="ID VARCHAR(40)")
    assert rows(spark, u, "T") == sorted(new)


def test_wrong_arguments(spark):
    df = frame(spark, [("a", 1, 1.0)])
    for bad in ({"mode": "changes"}, {"mode": "x"}, {"key": ["ID"]}, {"run": "a b"}):
        with pytest.raises(ValueError):
            J.write_table_once(df, url("once_bad"), "T", driver=DRIVER, **bad)
    with pytest.raises(ValueError):
        J.write_table_once(df, url("once_bad"), "T; DROP TABLE X", driver=DRIVER)


FAILING = """
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    from statflow.sources import jdbc_once as J, read_table
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp())
    u, driver = "jdbc:derby:memory:failing;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    data = spark.range(0, 4000, 1, 4).selectExpr("CAST(id AS STRING) AS ID", "CAST(id % 7 AS INT) AS V").checkpoint()

    def fail_late(batches):
        from pyspark import TaskContext
        for batch in batches:
            yield batch
        task = TaskContext.get()
        if task.partitionId() in (1, 3) and task.attemptNumber() < 2:
            raise RuntimeError("lost after its rows")

    J.write_table_once(data.limit(0), u, "T", driver=driver)
    tagged = J.tagged(data).mapInArrow(fail_late, J.tagged(data).schema)
    from statflow.sources.jdbc import write_table
    write_table(tagged, u, "T_stage_f", driver=driver, mode="append", batchsize=100)
    J.stage(data.filter("V >= 0"), u, "T_stage_f", driver=driver)  # and all partitions once more
    J.publish(spark, u, "T", "T_stage_f", "f", data.columns, 4, driver=driver)
    got = read_table(spark, u, "T", driver=driver)
    assert got.count() == 4000 and got.distinct().count() == 4000, (got.count(), got.distinct().count())
    print("each row once")
    spark.stop()
"""


def test_failing_and_duplicated_tasks(tmp_dir):
    """Tasks that fail after writing their rows are tried again; then every
    partition is committed a second time."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = os.path.join(tmp_dir, "failing.py")
    with open(script, "w") as f:
        f.write(textwrap.dedent(FAILING.format(root=root)))
    done = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=300, cwd=tmp_dir)
    assert "each row once" in done.stdout, done.stderr[-2000:]

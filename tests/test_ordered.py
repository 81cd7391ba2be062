"""Running totals over range partitions equal a plain cumulative sum."""

import random

from pyspark.sql import functions as F

from statflow.operators.ordered import running_totals


def test_running_totals_equal_a_cumulative_sum(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([1, 2, 5, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k string, v int")
    out = running_totals(df, [F.col("k").asc_nulls_last(), F.col("id")],
                         {"s": F.col("v"), "n": F.lit(1)})
    got = {r.id: (r.s, r.n) for r in out.collect()}
    want, s = {}, 0
    for n, (i, _, v) in enumerate(sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))):
        want[i] = (s, n)
        s += v or 0
    assert got == want
    assert out.columns == ["id", "k", "v", "s", "n"]


def test_running_totals_of_no_rows(spark):
    df = spark.createDataFrame([], "id int")
    assert running_totals(df, [F.col("id")], {"n": F.lit(1)}).collect() == []

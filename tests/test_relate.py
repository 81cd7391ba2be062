"""Joins, semi-join reduction and lookups (V9, V10, keys rows of FIXTURES)."""


from statflow.operators import (
    distinct_keys,
    inner_join,
    isin_filter,
    lookup_or_self,
    lookup_udf,
    map_lookup,
    row_count,
    semi_reduce,
)


def _df(spark, rows, schema="k string, v string"):
    return spark.createDataFrame(rows, schema)


def test_semi_reduce_equals_isin(spark):
    facts = _df(spark, [("a", "1"), ("b", "2"), (None, "3"), ("c", "4"), ("a", "5")])
    keys = _df(spark, [("a", "x"), ("a", "y"), (None, "z"), ("c", "w")])
    got = sorted(r.v for r in semi_reduce(facts, keys, "k").collect())
    wanted = [r.k for r in keys.select("k").distinct().collect() if r.k is not None]
    expected = sorted(r.v for r in isin_filter(facts, "k", wanted).collect())
    assert got == expected == ["1", "4", "5"]


def test_semi_reduce_empty_keys(spark):
    facts = _df(spark, [("a", "1")])
    assert semi_reduce(facts, _df(spark, []), "k").count() == 0


def test_inner_join_using_fans_out_and_drops_nulls(spark):
    left = _df(spark, [("a", "1"), (None, "2"), ("b", "3")])
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, w string")
    out = inner_join(left, right, "k")
    assert out.columns == ["k", "v", "w"]
    assert sorted((r.k, r.w) for r in out.collect()) == [("a", "x"), ("a", "y")]


def test_map_lookup_and_udf_agree(spark):
    codes = _df(spark, [("USA", "1"), ("FR", "2"), (None, "3")])
    mapping = {"USA": "United States"}
    a = codes.select("v", map_lookup("k", mapping).alias("c"))
    b = codes.select("v", lookup_udf(mapping)("k").alias("c"))
    assert sorted(a.collect()) == sorted(b.collect())
    assert {r.v: r.c for r in a.collect()} == {"1": "United States", "2": "FR", "3": None}


def test_lookup_or_self_table(spark):
    facts = _df(spark, [("USA", "1"), ("FR", "2"), (None, "3")])
    dim = spark.createDataFrame([("USA", "United States"), ("USA", "America")], "code string, name string")
    out = lookup_or_self(facts, "k", dim, "code", "name")
    assert out.columns == ["k", "v"]
    assert {r.v: r.k for r in out.collect()} == {"1": "United States", "2": "FR", "3": None}
    out = lookup_or_self(facts, "k", dim, "code", "name", out="country")
    assert out.columns == ["k", "v", "country"]


def test_lookup_or_self_leaves_the_join_to_spark(spark):
    facts = _df(spark, [("USA", "1")])
    dim = spark.createDataFrame([("USA", "United States")], "code string, name string")
    plan = lookup_or_self(facts, "k", dim, "code", "name")._jdf.queryExecution().optimizedPlan()
    assert "broadcast" not in plan.toString().lower()


def test_distinct_and_count(spark):
    df = _df(spark, [("a", "1"), ("a", "2"), ("b", "3")])
    assert sorted(r.k for r in distinct_keys(df, "k").collect()) == ["a", "b"]
    assert row_count(df).first().n == 3
    assert dict(row_count(df).dtypes)["n"] == "bigint"


def test_salted_joins_equal_plain(spark):
    hot = [("h", str(i)) for i in range(200)] + [("c", "x"), (None, "n")]
    facts = _df(spark, hot)
    right = spark.createDataFrame([("h", "H"), ("c", "C"), ("c", "C2")], "k string, w string")
    plain = sorted(inner_join(facts, right, "k").collect())
    salted = inner_join(facts, right, "k", salt=7)
    assert salted.columns == ["k", "v", "w"]
    assert sorted(salted.collect()) == plain and len(plain) == 202
    keys = _df(spark, [("h", "1"), ("h", "2")])
    assert sorted(semi_reduce(facts, keys, "k", salt=5).collect()) == sorted(
        semi_reduce(facts, keys, "k").collect())

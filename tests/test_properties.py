"""Property-based parity: random strings from number- and date-like
alphabets give the same result through the ANSI-safe recipes as through the
original job's casts (non-ANSI, LEGACY parser). Each example is a batch of
strings checked in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statflow.functions import int_trunc, parse_iso_date, parse_long_date, to_float
from tests.conftest import one_col
from tests.test_parity import _same, legacy_mode

SETTINGS = settings(max_examples=4, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))

number_text = st.text(alphabet="0123456789+-. eEfdNaIity\t\x00\n\r\u0085\u2028", max_size=10)
number_like = st.one_of(
    number_text,
    st.builds(lambda s, i, f, t: f"{s}{i}.{f}{t}",
              st.sampled_from(["", "-", "+", " "]), st.integers(0, 10**12),
              st.integers(0, 10**6), st.sampled_from(["", " ", "\t", "x"])),
)
month = st.sampled_from(["January", "Jan", "JANUARY", "february", "Sept", "Sep", "May", "Foo"])
long_date = st.builds(lambda lead, m, sp, d, comma, y, tail: f"{lead}{m}{sp}{d}{comma}{y}{tail}",
                      st.sampled_from(["", " "]), month, st.sampled_from([" ", "  ", "", "\t", " \n"]),
                      st.integers(0, 40), st.sampled_from([", ", ",", " , ", ",  "]),
                      st.integers(0, 30000), st.sampled_from(["", " (x)", "x", " 12", "\n", "\t"]))
iso_date = st.builds(lambda lead, y, m, d, sep, tail: f"{lead}{y}{sep}{m}{sep}{d}{tail}",
                     st.sampled_from(["", " "]), st.integers(0, 20000), st.integers(0, 14),
                     st.integers(0, 33), st.sampled_from(["-", "/", ""]),
                     st.sampled_from(["", "T00:00:00", " 12:00", "x", ".5", "\n", "\r\n"]))


def _check(spark, values, plain, recipe):
    df = one_col(spark, values)
    with legacy_mode(spark):
        expected = [r[0] for r in df.select(plain(F.col("v"))).collect()]
    got = [r[0] for r in df.select(recipe(F.col("v"))).collect()]
    bad = [(v, e, g) for v, e, g in zip(values, expected, got) if not _same(e, g)]
    assert not bad, bad[:5]


@SETTINGS
@given(st.lists(number_like, min_size=100, max_size=100))
def test_int_cast_property(spark, values):
    _check(spark, values, lambda c: c.cast("int"), int_trunc)


@SETTINGS
@given(st.lists(number_like, min_size=100, max_size=100))
def test_float_cast_property(spark, values):
    _check(spark, values, lambda c: c.cast("float"), to_float)


@SETTINGS
@given(st.lists(long_date, min_size=100, max_size=100))
def test_long_date_property(spark, values):
    plain = lambda c: F.unix_date(
        F.to_date(F.unix_timestamp(c, "MMMM dd, yyyy").cast("timestamp")))
    _check(spark, values, plain, lambda c: F.unix_date(parse_long_date(c)))


@SETTINGS
@given(st.lists(iso_date, min_size=100, max_size=100))
def test_iso_date_property(spark, values):
    _check(spark, values, lambda c: F.unix_date(F.to_date(c, "yyyy-MM-dd")),
           lambda c: F.unix_date(parse_iso_date(c)))


@SETTINGS
@given(st.lists(st.text(alphabet="ab \t\n\r\u2028\u00a0", max_size=8), min_size=60, max_size=60))
def test_tokens_match_jvm_split(spark, values):
    from statflow.functions import tokens

    # py4j returns java.lang.String as a Python str, so split through a
    # java.util.regex.Pattern to get the JVM's own rule.
    space = spark.sparkContext._jvm.java.util.regex.Pattern.compile(" ")
    expected = [list(space.split(v)) for v in values]
    got = [r[0] for r in one_col(spark, values).select(tokens("v")).collect()]
    bad = [(v, e, g) for v, e, g in zip(values, expected, got) if e != g]
    assert not bad, bad[:5]


keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"]))
left_rows = st.lists(st.tuples(keys, st.integers(0, 5)), min_size=0, max_size=40)
right_rows = st.lists(st.tuples(keys, st.integers(0, 5)), min_size=0, max_size=8)


@SETTINGS
@given(left_rows, right_rows)
def test_joins_match_brute_force(spark, left, right):
    from statflow.operators import inner_join, semi_reduce, skew_join

    left = left + [("hot", i) for i in range(12)]  # one key holds most rows
    lf = spark.createDataFrame(left, "k string, v int")
    rf = spark.createDataFrame(right, "k string, w int")
    inner = sorted((k, v, w) for k, v in left for k2, w in right if k is not None and k == k2)
    semi = sorted((k, v) for k, v in left if k is not None and any(k == k2 for k2, _ in right))
    assert sorted(map(tuple, inner_join(lf, rf, "k").collect())) == inner
    assert sorted(map(tuple, inner_join(lf, rf, "k", salt=3).collect())) == inner
    assert sorted(map(tuple, skew_join(lf, rf, "k", buckets=4).collect())) == inner
    assert sorted(map(tuple, semi_reduce(lf, rf, "k").collect())) == semi
    assert sorted(map(tuple, semi_reduce(lf, rf, "k", salt="auto").collect())) == semi

"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the entry smoke check and a brute-force word count."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from statflow.plans.queries import QUERIES
from tools.check_oracles import TABLES, duck_rows, spark_rows

SF = os.environ.get("STATFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert all(sql for _, sql in QUERIES.values())
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    scols, srows = spark_rows(E.queries()[name](spark, SF))
    dcols, drows = duck_rows(duck, E.oracle_sql()[name])
    assert scols == dcols
    assert len(srows) == len(drows)
    assert Counter(srows) == Counter(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "PLAYER_ID" and df.columns[-1] == "PLAYER_NAME"


def _jvm_split(text):
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if text != "" else [""]


def test_word_count_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = Counter()
    for r in docs.select("text").toLocalIterator():
        expected.update(_jvm_split(r.text))
    got = {r.word: r.n for r in E.queries()["word_count"](spark, SF).collect()}
    assert got == dict(expected)

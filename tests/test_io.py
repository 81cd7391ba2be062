"""Round trips: CSV landing -> typed tables -> CSV / Parquet / JDBC sinks.

JDBC runs against embedded in-memory Derby (shipped with Spark's jars): no
server process, no port."""

import os

import pytest

from statflow.plans import stat_tables as T
from statflow.sources import read_string_csv, read_table, write_csv, write_parquet, write_table
from tests import fixtures as X

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _write_sources(spark, base, info_rows=X.INFO_ROWS):
    frames = {
        "player_information": X.frame(spark, X.INFO_HEADER, info_rows),
        "player_leader": X.frame(spark, X.LEADER_HEADER, X.LEADER_ROWS),
        "player_box": X.frame(spark, X.BOX_HEADER, X.BOX_ROWS),
        "team_leader": X.frame(spark, X.TEAM_LEADER_HEADER, X.TEAM_LEADER_ROWS),
        "team_box": X.frame(spark, X.TEAM_BOX_HEADER, X.TEAM_BOX_ROWS),
    }
    for key, df in frames.items():
        write_csv(df.coalesce(1), f"{base}/{T.SOURCES[key]}.csv")


def test_csv_round_trip_keeps_strings(spark, tmp_dir):
    df = X.frame(spark, ["ID", "NAME, FULL", "V"], [("007", "a, b", "1.5"), ("008", None, "")])
    path = os.path.join(tmp_dir, "t.csv")
    write_csv(df, path)
    back = read_string_csv(spark, path, required=["ID", "V"])
    assert back.dtypes == [("ID", "string"), ("NAME, FULL", "string"), ("V", "string")]
    assert sorted(back.collect()) == [("007", "a, b", "1.5"), ("008", None, None)]


def test_read_string_csv_checks_required(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    write_csv(X.frame(spark, ["A"], [("1",)]), path)
    with pytest.raises(ValueError):
        read_string_csv(spark, path, required=["B"])


def test_run_daily_to_parquet(spark, tmp_dir):
    base, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "tables")
    _write_sources(spark, base)
    tables = T.run_daily(spark, base, lambda df, name: write_parquet(df, f"{out}/{name}"),
                         salt="auto", concurrent_writes=4)
    assert set(tables) == set(T.TABLES)
    info = spark.read.parquet(f"{out}/nba_player_information")
    assert info.count() == 3 and "PLAYER_NAME" in info.columns
    box = spark.read.parquet(f"{out}/nba_player_box_scores_rs")
    assert sorted(r.GAME_ID for r in box.collect()) == ["0022300001", "0022300002", "0022300003"]
    assert dict(box.dtypes)["GAME_DATE"] == "date"


def test_run_daily_to_jdbc_twice(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    # Derby's REAL has no NaN (PostgreSQL's has): use a NaN-free landing here.
    no_nan = [tuple("0.2" if v == "NaN" else v for v in r) for r in X.INFO_ROWS]
    _write_sources(spark, base, no_nan)
    url = "jdbc:derby:memory:statflow_daily;create=true"

    def jdbc(df, name):
        write_table(df, url, name, driver=DERBY_DRIVER, num_partitions=2, batchsize=500)

    for _ in range(2):  # overwrite semantics: the second run replaces the first
        T.run_daily(spark, base, jdbc)
    info = read_table(spark, url, "nba_player_information", driver=DERBY_DRIVER)
    assert info.count() == 3
    assert {"HEIGHT(m)", "WEIGHT(kg)", "PLAYER_NAME"} <= set(info.columns)
    team = read_table(spark, url, "nba_team_box_scores_rs", driver=DERBY_DRIVER,
                      partition_column="PTS", lower_bound=0, upper_bound=200, num_partitions=2)
    assert team.first().PTS == 128


def test_save_table_twin(spark, tmp_dir):
    from statflow.sources import save_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS statflow_test LOCATION '{tmp_dir}/db'")
    df = T.team_box_scores(X.frame(spark, X.TEAM_BOX_HEADER, X.TEAM_BOX_ROWS))
    save_table(df, "statflow_test.team_box", partition_by=["GAME_DATE"])
    back = spark.table("statflow_test.team_box")
    assert back.count() == 1 and dict(back.dtypes)["PTS"] == "int"
    spark.sql("DROP DATABASE statflow_test CASCADE")


def test_reordered_csv_landing_fails_instead_of_swapping(spark, tmp_dir):
    d = os.path.join(tmp_dir, "landing")
    os.makedirs(d)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("A,B\n1,2\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("B,A\n3,4\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_string_csv(spark, d).collect()
    loose = read_string_csv(spark, d, check_headers=False)
    assert sorted(loose.collect()) == [("1", "2"), ("3", "4")]  # positional binding


def test_bucketed_tables_join_without_shuffle(spark, tmp_dir):
    from statflow.operators import semi_reduce
    from statflow.sources import save_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS statflow_bkt LOCATION '{tmp_dir}/bkt'")
    info = T.player_information(X.frame(spark, X.INFO_HEADER, X.INFO_ROWS),
                                X.frame(spark, X.LEADER_HEADER, X.LEADER_ROWS))
    box = X.frame(spark, X.BOX_HEADER, X.BOX_ROWS)
    save_table(info, "statflow_bkt.info", bucket_by=(4, ["PLAYER_ID"]))
    save_table(box, "statflow_bkt.box", bucket_by=(4, ["PLAYER_ID"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = semi_reduce(spark.table("statflow_bkt.box"), spark.table("statflow_bkt.info"),
                             "PLAYER_ID")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE statflow_bkt CASCADE")


def test_payload_lines(spark, tmp_dir):
    from statflow.operators import unpack_rowset
    from statflow.sources import read_payloads
    from tests.test_unpack import FORM1, FORM2

    path = os.path.join(tmp_dir, "captures.jsonl")
    with open(path, "w") as f:
        f.write(FORM1 + "\n" + FORM2 + "\n")
    out = unpack_rowset(read_payloads(spark, path, one_per_line=True), columns=["ID"])
    assert sorted(r.ID for r in out.collect()) == ["1", "2", "3", "4.5"]


def test_jdbc_overwrite_with_truncate_keeps_the_table(spark):
    url = "jdbc:derby:memory:statflow_trunc;create=true"
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_table(first, url, "t", driver=DERBY_DRIVER)
    second = spark.createDataFrame([("c", 3)], "k string, v int")
    write_table(second, url, "t", driver=DERBY_DRIVER, truncate=True)
    back = read_table(spark, url, "t", driver=DERBY_DRIVER)
    assert [tuple(r) for r in back.collect()] == [("c", 3)]

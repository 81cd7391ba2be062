"""The command-line jobs, driven in-process with the test session."""

import json
import os

from statflow.jobs import run
from tests import fixtures as X
from tests.test_io import _write_sources
from tests.test_unpack import FORM1, FORM2, PAGE


def test_daily_to_parquet(spark, tmp_dir):
    base, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    _write_sources(spark, base)
    run(spark, ["daily", "--source", base, "--out", out])
    assert sorted(os.listdir(out)) == sorted(
        ["nba_player_information", "nba_player_box_scores_rs", "nba_player_leader",
         "nba_team_leader", "nba_team_box_scores_rs"])


def test_daily_to_jdbc_with_password_file(spark, tmp_dir):
    base = os.path.join(tmp_dir, "landing")
    no_nan = [tuple("0.2" if v == "NaN" else v for v in r) for r in X.INFO_ROWS]
    _write_sources(spark, base, no_nan)
    pw = os.path.join(tmp_dir, "pw")
    with open(pw, "w") as f:
        f.write("secret\n")
    url = "jdbc:derby:memory:statflow_cli;create=true"
    run(spark, ["daily", "--source", base, "--jdbc-url", url, "--password-file", pw,
                "--user", "app", "--driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver"])
    got = spark.read.format("jdbc").options(
        url=url, dbtable="nba_team_leader", user="app", password="secret",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").load()
    assert got.count() == 1


def test_wordcount_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "text.txt")
    with open(src, "w") as f:
        f.write("Hello World\nHello spark\nHello Docker\nHello Scala\nHello Python\n")
    out = os.path.join(tmp_dir, "wc")
    run(spark, ["wordcount", "--input", src, "--out", out])
    counts = {r.word: r.n for r in spark.read.parquet(out).collect()}
    assert counts == {"Hello": 5, "World": 1, "spark": 1, "Docker": 1, "Scala": 1, "Python": 1}


def test_land_payloads_and_pages_jobs(spark, tmp_dir):
    pdir, pgdir = os.path.join(tmp_dir, "payloads"), os.path.join(tmp_dir, "pages")
    os.makedirs(pdir)
    os.makedirs(pgdir)
    for i, text in enumerate([FORM1, FORM2]):
        with open(os.path.join(pdir, f"{i}.json"), "w") as f:
            f.write(text)
    with open(os.path.join(pgdir, "2544.html"), "w") as f:
        f.write(PAGE)
    with open(os.path.join(pdir, "overlong.json"), "w") as f:
        f.write(json.dumps({"resultSet": {"headers": ["ID"], "rowSet": [[9, "extra"]]}}))
    out, quarantine = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "q")
    run(spark, ["land-payloads", "--input", pdir, "--out", out, "--columns", "ID,NM",
                "--quarantine", quarantine])
    (bad,) = spark.read.parquet(quarantine).collect()
    assert bad.source.endswith("overlong.json") and bad["values"] == ["9", "extra"]
    landed = spark.read.option("header", True).csv(out)
    assert sorted(r.ID for r in landed.collect()) == ["1", "2", "3", "4.5"]
    run(spark, ["land-payloads", "--input", pdir, "--out", out + "2", "--columns", "ID,NM",
                "--quarantine", quarantine + "2", "--ranges"])
    ranged = spark.read.option("header", True).csv(out + "2")
    assert sorted(map(str, ranged.collect())) == sorted(map(str, landed.collect()))
    (bad,) = spark.read.parquet(quarantine + "2").collect()
    assert bad.source.endswith("overlong.json") and bad["values"] == ["9", "extra"]
    rows, bad = os.path.join(tmp_dir, "rows"), os.path.join(tmp_dir, "bad")
    run(spark, ["land-pages", "--input", pgdir, "--out", rows, "--quarantine", bad])
    got = spark.read.option("header", True).csv(rows).collect()
    assert [r.PLAYER_ID for r in got] == ["2544"]
    assert json.loads(json.dumps(got[0].asDict()))["POSITION"].endswith("Forward")
    rows2, bad2 = os.path.join(tmp_dir, "rows2"), os.path.join(tmp_dir, "bad2")
    run(spark, ["land-pages", "--input", pgdir, "--out", rows2, "--quarantine", bad2,
                "--parser"])
    got2 = spark.read.option("header", True).csv(rows2).collect()
    assert [r.asDict() for r in got2] == [r.asDict() for r in got]


def test_land_pages_by_paths_job(spark, tmp_dir):
    from tests.test_htmlpaths import page

    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    with open(os.path.join(pages, "77.html"), "w") as f:
        f.write(page("abcd", "efgh", "ijkl", "<p>Guard</p>"))
    rows, bad = os.path.join(tmp_dir, "rows"), os.path.join(tmp_dir, "bad")
    run(spark, ["land-pages", "--input", pages, "--out", rows, "--quarantine", bad, "--paths"])
    (got,) = spark.read.option("header", True).csv(rows).collect()
    assert list(got) == ["77", *"abcdefghijkl", "Guard"]


def test_land_stream_job(spark, tmp_dir):
    from statflow.sources import write_csv

    src, out = os.path.join(tmp_dir, "drops"), os.path.join(tmp_dir, "typed")
    write_csv(X.frame(spark, X.TEAM_BOX_HEADER, X.TEAM_BOX_ROWS).coalesce(1), f"{src}/day1")
    run(spark, ["land-stream", "--table", "team_box", "--source", f"{src}/*", "--out", out,
                "--checkpoint", os.path.join(tmp_dir, "progress")])
    got = spark.read.parquet(out)
    assert got.count() == 1 and dict(got.dtypes)["GAME_DATE"] == "date"


def test_land_stream_job_starts_on_an_empty_folder(spark, tmp_dir):
    from statflow.sources import write_csv

    src, out = os.path.join(tmp_dir, "drops"), os.path.join(tmp_dir, "typed")
    os.makedirs(src)
    args = ["land-stream", "--table", "team_box", "--source", src, "--out", out, "--checkpoint",
            os.path.join(tmp_dir, "progress"), "--columns", ",".join(X.TEAM_BOX_HEADER)]
    run(spark, args)
    write_csv(X.frame(spark, X.TEAM_BOX_HEADER, X.TEAM_BOX_ROWS).coalesce(1), f"{tmp_dir}/day1")
    for name in os.listdir(f"{tmp_dir}/day1"):
        if name.endswith(".csv"):
            os.link(f"{tmp_dir}/day1/{name}", f"{src}/{name}")
    run(spark, args)
    assert spark.read.parquet(out).count() == 1


def test_daily_versioned_and_once(spark, tmp_dir):
    from statflow.sources import read_table, read_tables

    base, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    no_nan = [tuple("0.2" if v == "NaN" else v for v in r) for r in X.INFO_ROWS]
    _write_sources(spark, base, no_nan)
    run(spark, ["daily", "--source", base, "--out", out, "--versioned", "--by-name"])
    assert read_tables(spark, out)["nba_player_information"].count() == 3
    url, driver = "jdbc:derby:memory:statflow_once;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    for _ in range(2):
        run(spark, ["daily", "--source", base, "--jdbc-url", url, "--driver", driver, "--once"])
    assert read_table(spark, url, "nba_player_information", driver=driver).count() == 3

"""Command-line jobs (``spark-submit statflow/jobs.py ...`` or
``python -m statflow ...``). The session comes from ``spark-submit``; the
jobs add only an application name and the settings of
``session.RECOMMENDED_CONF`` that the submitter left unset.

  daily          five CSV landings -> five typed tables (JDBC or Parquet)
  wordcount      text files -> (word, n)
  land-payloads  captured API responses -> one string table (CSV/Parquet)
  land-pages     stored profile pages -> profile rows + quarantine
  land-stream    new CSV drops of one table -> typed Parquet, incrementally
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.operators.wordcount import word_count
from statflow.plans import stat_tables as T
from statflow.plans.profiles import (
    PLAYER_LEADER_PROFILE,
    TEAM_BOX_PROFILE,
    TEAM_LEADER_PROFILE,
)
from statflow.sources.csv import read_string_csv, write_csv
from statflow.sources.files import read_pages, write_parquet
from statflow.sources.jdbc import write_table
from statflow.sources.jdbc_once import write_table_once
from statflow.session import apply_recommended
from statflow.streaming.landing import land_stream

# Tables that can be landed incrementally (the G1 join and G2 semi-join need
# whole tables: those two tables come from the daily run alone).
STREAM_PROFILES = {
    "player_leader": PLAYER_LEADER_PROFILE,
    "team_leader": TEAM_LEADER_PROFILE,
    "team_box": TEAM_BOX_PROFILE,
}


def _password(args: argparse.Namespace) -> str | None:
    if args.password_file:
        with open(args.password_file) as f:
            return f.read().strip()
    return None


def table_writer(args: argparse.Namespace) -> Callable[[DataFrame, str], None]:
    """``--jdbc-url`` writes tables over JDBC (overwrite), else Parquet under
    ``--out``."""
    if args.jdbc_url:
        password = _password(args)

        def to_jdbc(df: DataFrame, name: str) -> None:
            table = f"{args.schema}.{name}" if args.schema else name
            if args.once:
                write_table_once(df, args.jdbc_url, table, args.user, password, args.driver,
                                 num_partitions=args.jdbc_partitions, batchsize=args.batchsize)
                return
            write_table(df, args.jdbc_url, table, user=args.user, password=password,
                        driver=args.driver, num_partitions=args.jdbc_partitions,
                        batchsize=args.batchsize)

        return to_jdbc
    if not args.out:
        raise SystemExit("give --jdbc-url or --out")

    def to_parquet(df: DataFrame, name: str) -> None:
        write_parquet(df, f"{args.out.rstrip('/')}/{name}")

    return to_parquet


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv(df, path)
    else:
        write_parquet(df, path)


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    p = argparse.ArgumentParser(prog="statflow")
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily", help="five landings -> five typed tables")
    d.add_argument("--source", required=True, help="folder (Hadoop URI) of the five CSVs")
    d.add_argument("--out", help="Parquet folder for the tables")
    d.add_argument("--jdbc-url")
    d.add_argument("--schema", default=None, help="database schema, e.g. public")
    d.add_argument("--user")
    d.add_argument("--password-file", help="file holding the database password")
    d.add_argument("--driver")
    d.add_argument("--jdbc-partitions", type=int, default=None)
    d.add_argument("--batchsize", type=int, default=None)
    d.add_argument("--salt", default="auto",
                   help='buckets for heavy PLAYER_IDs in the joins; "auto": as many as '
                        "shuffle partitions; 1: none")
    d.add_argument("--concurrent-writes", type=int, default=1,
                   help="write the four tables after G1 with this many concurrent jobs")

    d.add_argument("--versioned", action="store_true",
                   help="Parquet tables under --out are shown together, by one manifest at the end")
    d.add_argument("--by-name", action="store_true",
                   help="bind the columns of every landing file by name (reordered, more or fewer columns)")
    d.add_argument("--once", action="store_true",
                   help="JDBC tables through staging and ledger: each row once, also when tasks run twice")

    w = sub.add_parser("wordcount", help="text files -> (word, n)")
    w.add_argument("--input", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--format", choices=["csv", "parquet"], default="parquet")

    lp = sub.add_parser("land-payloads", help="API responses -> string table")
    lp.add_argument("--input", required=True)
    lp.add_argument("--out", required=True)
    lp.add_argument("--columns", default=None, help="comma-separated header names")
    lp.add_argument("--format", choices=["csv", "parquet"], default="csv")
    lp.add_argument("--quarantine", required=True,
                    help="Parquet folder for unreadable payloads and over-long rows")
    lp.add_argument("--json-lines", action="store_true", help="captures hold one response per line")
    lp.add_argument("--ranges", action="store_true",
                    help="captures may be larger than a task: read their rows by byte ranges")

    pg = sub.add_parser("land-pages", help="stored pages -> profile rows")
    pg.add_argument("--input", required=True)
    pg.add_argument("--out", required=True)
    pg.add_argument("--quarantine", required=True)
    pg.add_argument("--key-pattern", default=r"(\d+)[^/]*$",
                    help="regex with one group taking the player id from the file path")
    pg.add_argument("--parser", action="store_true",
                    help="find blocks with an HTML parser (nested templates) instead of regex")
    pg.add_argument("--paths", action="store_true",
                    help="find blocks by their places in the element tree (pages as the source serves them)")

    st = sub.add_parser("land-stream", help="new CSV drops of one table -> typed Parquet")
    st.add_argument("--table", required=True, choices=sorted(STREAM_PROFILES))
    st.add_argument("--source", required=True, help="folder receiving the CSV drops")
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True,
                    help="shared folder for this stream's progress; keep it between runs")
    st.add_argument("--columns", default=None,
                    help="comma-separated header of the drops; without it the folder must hold one already")
    st.add_argument("--continuous", action="store_true",
                    help="keep running (1-minute trigger) instead of availableNow")

    args = p.parse_args(list(argv))
    if args.cmd == "daily":
        salt = args.salt if args.salt == "auto" else int(args.salt)
        if args.versioned:
            T.run_daily_published(spark, args.source, args.out, salt, args.concurrent_writes, args.by_name)
        else:
            T.run_daily(spark, args.source, table_writer(args), salt=salt,
                        concurrent_writes=args.concurrent_writes, by_name=args.by_name)
    elif args.cmd == "wordcount":
        lines = spark.read.text(args.input).withColumnRenamed("value", "text")
        _write(word_count(lines, "text"), args.out, args.format)
    elif args.cmd == "land-payloads":
        cols = args.columns.split(",") if args.columns else None
        if args.ranges:
            good, bad = T.land_captures(spark, args.input, cols)
        else:
            good, bad = T.land_payloads(spark, args.input, cols, args.json_lines)
        _write(good, args.out, args.format)
        write_parquet(bad, args.quarantine)
    elif args.cmd == "land-pages":
        pages = read_pages(spark, args.input).withColumn(
            "PLAYER_ID", F.regexp_extract("source", args.key_pattern, 1)
        )
        land = T.land_pages_by_path if args.paths else T.land_pages_parsed if args.parser else T.land_pages
        good, bad = land(pages)
        write_csv(good, args.out)
        write_parquet(bad, args.quarantine)
    elif args.cmd == "land-stream":
        header = args.columns.split(",") if args.columns else read_string_csv(spark, args.source).columns
        q = land_stream(spark, args.source, header, STREAM_PROFILES[args.table], args.out,
                        args.checkpoint, f"land_{args.table}", available_now=not args.continuous)
        q.awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    spark = SparkSession.builder.appName("statflow").getOrCreate()
    apply_recommended(spark)
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()

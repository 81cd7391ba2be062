"""Registered queries of the landing operators that need a layout of their own:
pages, captures and snapshots are derived from whole driver tables, and the
oracle states the values straight from those tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.functions import positional_columns
from statflow.operators.changes import apply_changes, snapshot_changes
from statflow.operators.htmlpaths import extract_page_row_paths
from statflow.operators.unpack import flag_malformed, page_row_is_bad
from statflow.plans.profiles import PLAYER_INFORMATION_HEADER
from statflow.plans.stat_tables import PAGE_INFO_PATHS, PAGE_POSITION_PATH, PAGE_STAT_PATH
from statflow.session import ensure_checkpoint_dir
from statflow.sources.captures import read_capture_rows
from statflow.sources.files import load
from statflow.sources.headers import read_any_csv
from statflow.sources.manifest import land_new, read_landed

# --- S4 G8: profile pages addressed by element paths --------------------------

# Values of a page, in both dialects. Stats number 0 to 4 (5 in some pages);
# the first info block of some pages has no value line, some have no position.
_N_STATS = "CASE WHEN c_custkey % 19 = 0 THEN 5 ELSE c_custkey % 5 END"
_STAT = "concat(CAST(c_custkey * ({i} + 3) % 40 AS STRING), '.', CAST((c_custkey + {i}) % 10 AS STRING))"
_INFO = "concat('v', '{i}', ' & ', CAST(c_custkey % (100 + {i}) AS STRING))"
_POSITION = "concat('#', CAST(c_custkey % 50 AS STRING), ' | ', c_mktsegment)"


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A profile page per customer, laid out as the source's paths say, among
    siblings of other tags, comments, scripts and attributes that look like
    tags; every 13th page leaves out the tags that HTML implies."""
    rule = "<hr><div class=\"sep\"></div>"

    def shown(sql: str) -> str:
        return f"replace({sql}, '&', '&amp;')"

    stats = "concat(" + ", ".join(
        f"""CASE WHEN {_N_STATS} > {i} THEN concat('{rule}<DIV title="</div>"><p>S{i}<p>', {shown(_STAT.format(i=i))},
            '</DIV>') ELSE '' END""" for i in range(5)) + ")"

    def info(numbers: range) -> str:
        return "concat(" + ", ".join(
            f"""'<div><span>L{i}</span><br>', {shown(_INFO.format(i=i))}, '</div>{rule}'""" if i else
            f"""CASE WHEN c_custkey % 17 = 0 THEN '<div>L0</div>{rule}' ELSE
                concat('<div><span>L0</span><br>', {shown(_INFO.format(i=0))}, '</div>{rule}') END"""
            for i in numbers) + ")"

    head = "<!DOCTYPE html><html><head><title>Profile</title><script>var s = \"<div><div>\";</script></head><body>"
    position = (f"CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('<p>', {shown(_POSITION)}, '</p><p>second</p>') END")
    page = f"""concat(
        CASE WHEN c_custkey % 13 = 0 THEN '<!-- no head --><title>Profile</title>' ELSE '{head}' END,
        '<!-- <div> --><span>ad</span><div id="next"><div>menu<ul><li>a<li>b</ul></div>',
        '<section>not here</section><div><div>left</div><div><section><div>',
        '<section><div>photo</div><div><div><div>team</div><div><div>', {position}, '</div></div></div></div></section>',
        '<section><div><div>', {stats}, '</div><div><div>h1</div><div>', {info(range(4))},
        '</div><div>h2</div><div>', {info(range(4, 8))}, '</div></div></div></section>',
        '</div></section></div></div></div><div><div>x</div><div><div>y</div></div></div>',
        CASE WHEN c_custkey % 13 = 0 THEN '' ELSE '</body></html>' END)"""
    # parsing a page takes about a thousand times as long as reading its row: rows of a
    # small file (one row group is one task) are dealt out over all tasks first
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    customers = load(spark, sf, "customer").select("c_custkey", "c_mktsegment").repartition(tasks)
    return customers.selectExpr("c_custkey AS page_id", f"{page} AS html")


def page_row_paths(spark: SparkSession, sf: str) -> DataFrame:
    """S4 by the source's own four paths."""
    rows = extract_page_row_paths(profile_pages(spark, sf), "html", "page_id", PAGE_STAT_PATH,
                                  PAGE_INFO_PATHS, PAGE_POSITION_PATH)
    flagged = flag_malformed(rows, page_row_is_bad("values", len(PLAYER_INFORMATION_HEADER)))
    return flagged.select(*positional_columns("values", PLAYER_INFORMATION_HEADER),
                          F.size("values").alias("n_values"), "malformed")


def _oracle_page_row_paths() -> str:
    stats = ", ".join(f"CASE WHEN {_N_STATS} > {i} THEN {_STAT.format(i=i)} ELSE '--' END" for i in range(4))
    fifth = f"CASE WHEN {_N_STATS} > 4 THEN [{_STAT.format(i=4)}] ELSE [] END"
    infos = ", ".join(_INFO.format(i=i) if i else f"CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE {_INFO.format(i=0)} END"
                      for i in range(8))
    position = f"CASE WHEN c_custkey % 11 = 0 THEN '' ELSE {_POSITION} END"
    values = f"list_concat([CAST(c_custkey AS STRING), {stats}], {fifth}, [{infos}, {position}])"
    columns = ", ".join(f'v[{i + 1}] AS "{n}"' for i, n in enumerate(PLAYER_INFORMATION_HEADER))
    return (f"SELECT {columns}, CAST(len(v) AS INTEGER) AS n_values, "
            f"len(v) > {len(PLAYER_INFORMATION_HEADER)} OR k % 17 = 0 AS malformed\n"
            f"FROM (SELECT c_custkey AS k, {values} AS v FROM customer)")


ORACLE_PAGE_ROW_PATHS = _oracle_page_row_paths()


# --- S3 G7: captures read by byte ranges ---------------------------------------

#: Orders per capture, and bytes of a range: a capture is many ranges here.
_CAPTURE_ORDERS, _CAPTURE_RANGE = 20_000, 1 << 18
_CAPTURE_COLUMNS = ["L_ORDERKEY", "L_LINENUMBER", "NOTE", "PRICE"]


def captures(spark: SparkSession, sf: str) -> str:
    """A folder with one captured response per ``_CAPTURE_ORDERS`` orders, a
    row per line item (and one before them), with brackets, quotes and
    backslashes inside strings; every fifth capture breaks off."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-captures-{uuid.uuid4().hex}"
    note = r"""concat('], [\\"', l_returnflag, '\\\\', l_linestatus, '{')"""
    rows = load(spark, sf, "lineitem").selectExpr(
        f"l_orderkey div {_CAPTURE_ORDERS} AS capture", "l_orderkey AS o", "l_linenumber AS n",
        f"""concat(',[', l_orderkey, ',', l_linenumber, ',"', {note}, '",',
            format_string('%.2f', l_extendedprice), IF(l_linenumber = 6, ',0', ''), ']') AS value""")
    names = ",".join(f'"{n}"' for n in _CAPTURE_COLUMNS)
    ids = rows.select("capture").distinct()
    head = ids.selectExpr("capture", "-1L AS o", "0 AS n",
                          f"""'{{"resultSet":{{"name":"x]","headers":[{names}],"rowSet":[[-1,0,null,1.50]' AS value""")
    tail = ids.selectExpr("capture", f"{(1 << 62)} AS o", "0 AS n", "IF(capture % 5 = 4, '', ']}}') AS value")
    (head.unionByName(rows).unionByName(tail).repartition("capture")
     .sortWithinPartitions("capture", "o", "n").select("capture", "value")
     .write.partitionBy("capture").text(folder))
    return folder


def capture_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S3 by byte ranges: rows and quarantine of captures of many ranges."""
    found = read_capture_rows(spark, captures(spark, sf), _CAPTURE_COLUMNS, _CAPTURE_RANGE)
    return found.select(F.regexp_extract("source", "capture=([0-9]+)", 1).cast("long").alias("capture"),
                        "status", *_CAPTURE_COLUMNS, F.size("values").alias("n_values"))


ORACLE_CAPTURE_ROWS = f"""
WITH rows AS (
  SELECT l_orderkey // {_CAPTURE_ORDERS} AS capture, CAST(l_orderkey AS VARCHAR) AS o, CAST(l_linenumber AS VARCHAR) AS n,
         '], ["' || l_returnflag || chr(92) || l_linestatus || '{{' AS note,
         CAST(CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS VARCHAR) AS price, l_linenumber = 6 AS long
  FROM lineitem
  UNION ALL
  SELECT DISTINCT l_orderkey // {_CAPTURE_ORDERS}, '-1', '0', NULL, '1.5', false FROM lineitem
)
SELECT capture, CASE WHEN long THEN 'over_long' ELSE 'ok' END AS status,
       CASE WHEN NOT long THEN o END AS "L_ORDERKEY", CASE WHEN NOT long THEN n END AS "L_LINENUMBER",
       CASE WHEN NOT long THEN note END AS "NOTE", CASE WHEN NOT long THEN price END AS "PRICE",
       CASE WHEN long THEN 5 END AS n_values
FROM rows WHERE capture % 5 <> 4
UNION ALL
SELECT DISTINCT capture, 'unreadable', NULL, NULL, NULL, NULL, CAST(NULL AS INTEGER) FROM rows WHERE capture % 5 = 4"""


# --- G1-G5: changed rows only ---------------------------------------------------

def order_snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the orders, keyed by customer and day: the second lacks
    some orders, has others that the first lacks, other prices, other statuses
    (also NULL) and columns in another order."""
    orders = load(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    old = orders.filter("o_orderkey % 11 <> 0").select(
        "o_custkey", "day", "o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.filter("o_orderkey % 13 <> 0").select(
        F.expr("o_totalprice + IF(o_orderkey % 17 = 0, 1, 0)").alias("o_totalprice"),
        F.expr("IF(o_orderkey % 19 = 0, NULL, o_orderstatus)").alias("o_orderstatus"),
        "o_orderkey", "day", "o_custkey")
    return old, new


_SNAPSHOT_KEY = ["o_custkey", "day"]


def snapshot_changes_q(spark: SparkSession, sf: str) -> DataFrame:
    old, new = order_snapshots(spark, sf)
    return snapshot_changes(old, new, _SNAPSHOT_KEY)


def apply_changes_q(spark: SparkSession, sf: str) -> DataFrame:
    """The old snapshot after the changes: the new one."""
    old, new = order_snapshots(spark, sf)
    return apply_changes(old, snapshot_changes(old, new, _SNAPSHOT_KEY), _SNAPSHOT_KEY)


_SNAPSHOTS = """
WITH old AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_orderstatus, o_totalprice
  FROM orders WHERE o_orderkey % 11 <> 0
), new AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey,
         CASE WHEN o_orderkey % 19 <> 0 THEN o_orderstatus END AS o_orderstatus,
         o_totalprice + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS o_totalprice
  FROM orders WHERE o_orderkey % 13 <> 0
)"""
ORACLE_SNAPSHOT_CHANGES = _SNAPSHOTS + """, differing AS (
  SELECT DISTINCT o_custkey, day FROM (
    (SELECT * FROM old EXCEPT ALL SELECT * FROM new) UNION ALL (SELECT * FROM new EXCEPT ALL SELECT * FROM old))
)
SELECT n.*, CASE WHEN (o_custkey, day) IN (SELECT (o_custkey, day) FROM old) THEN 'update' ELSE 'insert' END AS change
FROM new n JOIN differing USING (o_custkey, day)
UNION ALL
SELECT o_custkey, day, NULL, NULL, NULL, 'delete' FROM differing
WHERE (o_custkey, day) NOT IN (SELECT (o_custkey, day) FROM new)"""
ORACLE_APPLY_CHANGES = _SNAPSHOTS + """
SELECT * FROM new"""


# --- S1 S2: files bound by name, objects landed once ------------------------------

#: The columns of each priority's files, in their order.
_CSV_COLUMNS = {
    "1-URGENT": ["o_orderkey", "o_custkey", "o_orderstatus", "day"],
    "2-HIGH": ["day", "o_orderstatus", "o_custkey", "o_orderkey"],
    "3-MEDIUM": ["o_custkey", "o_orderkey"],
    "4-NOT SPECIFIED": ["o_orderkey", "o_custkey", "o_orderstatus", "day"],
    "5-LOW": ["o_orderstatus", "o_orderkey", "o_totalprice", "o_custkey", "day"],
}


def _query_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-{name}-{uuid.uuid4().hex}"


def _write_orders(spark: SparkSession, sf: str, folder: str, priorities: list[str]) -> None:
    """The orders of some priorities as CSV files below ``folder``."""
    orders = load(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    for p in priorities:
        (orders.filter(F.col("o_orderpriority") == p).select(*_CSV_COLUMNS[p]).repartition(4, "o_orderkey")
         .write.mode("append").option("header", True).csv(f"{folder}/{p[0]}"))


def csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """S1: files of four headers, one table."""
    folder = _query_folder(spark, "csv")
    _write_orders(spark, sf, folder, list(_CSV_COLUMNS))
    return read_any_csv(spark, [f"{folder}/{p[0]}" for p in _CSV_COLUMNS],
                        header=["o_orderkey", "o_custkey", "o_orderstatus", "day"])


ORACLE_CSV_BY_NAME = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders"""


def landed_once(spark: SparkSession, sf: str) -> DataFrame:
    """S2: three landings of a growing folder; every object is landed by one.
    ``pass`` tells which."""
    folder = _query_folder(spark, "objects")
    source, manifest, out = (f"{folder}/{n}" for n in ("in", "manifest", "out"))
    passes = []
    for priorities in (["1-URGENT", "2-HIGH"], ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], []):
        _write_orders(spark, sf, source, priorities)
        done = []

        def land(paths: list[str], run: str, done: list = done) -> None:
            read_any_csv(spark, paths, header=["o_orderkey"]).write.parquet(f"{out}/run={run}")
            done.append(run)

        land_new(spark, source, manifest, land, pattern="*.csv")
        passes += [(run, len(passes) + 1) for run in done]
    runs = spark.createDataFrame(passes, "run string, pass int")
    return read_landed(spark, manifest, out).join(runs, "run").select("o_orderkey", "pass")


ORACLE_LANDED_ONCE = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 2 END AS INTEGER) AS pass
FROM orders"""


LANDING_QUERIES = {
    "csv_by_name": (csv_by_name, ORACLE_CSV_BY_NAME),
    "landed_once": (landed_once, ORACLE_LANDED_ONCE),
    "snapshot_changes": (snapshot_changes_q, ORACLE_SNAPSHOT_CHANGES),
    "apply_changes": (apply_changes_q, ORACLE_APPLY_CHANGES),
    "capture_rows": (capture_rows, ORACLE_CAPTURE_ROWS),
    "page_row_paths": (page_row_paths, ORACLE_PAGE_ROW_PATHS),
}

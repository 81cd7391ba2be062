"""Registered queries: one per operator of the inventory, run on the driver
tables (whole tables, no sampling), each with a DuckDB oracle describing the
expected result independently of the Spark implementation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.functions import (
    extract_number,
    int_trunc,
    json_field,
    last_segment,
    null_to_zero,
    parse_iso_date,
    parse_long_date,
    positional_columns,
    second_line,
    strip_unit,
    to_float,
)
from statflow.functions.strings import (
    AGE_UNIT,
    KILOGRAMS,
    METRES_IN_BRACKETS,
    ROOKIE_WORD,
    YEARS_UNIT,
)
from statflow.operators import (
    Profile,
    extract_page_row_parsed,
    Rule,
    apply_profile,
    distinct_keys,
    drop_short_rows,
    extract_page_row,
    flag_malformed,
    floats,
    inner_join,
    ints,
    isin_filter,
    lookup_or_self,
    lookup_udf,
    map_lookup,
    page_row_is_bad,
    row_count,
    semi_reduce,
    split_malformed,
    stringify,
    unpack_rowset_flagged,
    word_count,
)
from statflow.plans import driver_flows as D
from statflow.plans import reports as R
from statflow.plans.landing_queries import LANDING_QUERIES
from statflow.plans.profiles import PLAYER_INFORMATION_HEADER
from statflow.sources.files import load

Query = Callable[[SparkSession, str], DataFrame]


# --- P2 P5 P6: a whole table through a type profile --------------------------

_LINEITEM_PROFILE = Profile(
    rules={
        **ints(["l_linenumber", "l_quantity"]),
        **floats(["l_extendedprice", "l_discount", "l_tax"]),
        "l_shipdate": Rule("iso_date"),
    },
    rename={"l_returnflag": "returnflag"},
    drop=("l_linestatus", "not_a_column"),
)


def type_profile_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    raw = stringify(load(spark, sf, "lineitem"), money=["l_extendedprice"])
    return apply_profile(raw, _LINEITEM_PROFILE)


ORACLE_TYPE_PROFILE_LINEITEM = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
       CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount,
       CAST(l_tax AS FLOAT) AS l_tax, l_returnflag AS returnflag,
       CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem"""


# --- P5: truncating integer cast ---------------------------------------------

def int_trunc_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    money = F.format_string("%.2f", "o_totalprice")
    bad = F.when(F.col("o_orderkey") % 10 == 0, F.format_string("%e", "o_totalprice")).otherwise(
        money
    )
    return o.select(
        "o_orderkey",
        int_trunc(money).alias("total_int"),
        int_trunc(F.concat(F.lit("-"), money)).alias("neg_int"),
        int_trunc(F.concat(F.lit(" "), money, F.lit("\t"))).alias("padded_int"),
        int_trunc(bad).alias("exp_int"),
    )


ORACLE_INT_TRUNC_ORDERS = """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS total_int,
       CAST(-trunc(o_totalprice) AS INTEGER) AS neg_int,
       CAST(trunc(o_totalprice) AS INTEGER) AS padded_int,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL
            ELSE CAST(trunc(o_totalprice) AS INTEGER) END AS exp_int
FROM orders"""


# --- P6 / X9 F2: tolerant float and NULL -> 0 --------------------------------

def _discount_raw() -> F.Column:
    return F.when(F.col("l_linenumber") == 7, F.lit("--")).otherwise(
        F.col("l_discount").cast("string")
    )


def float_bad_to_null(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", to_float(_discount_raw()).alias("discount"))


ORACLE_FLOAT_BAD_TO_NULL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_discount AS FLOAT) END AS discount
FROM lineitem"""


def null_to_zero_q(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", null_to_zero(to_float(_discount_raw())).alias("discount")
    )


ORACLE_NULL_TO_ZERO = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN CAST(0 AS FLOAT) ELSE CAST(l_discount AS FLOAT) END
         AS discount
FROM lineitem"""


# --- X3 X4 X5: unit stripping -------------------------------------------------

def strip_unit_size(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    size = F.col("p_size").cast("string")
    exp_raw = F.concat(size, F.when(F.col("p_size") % 2 == 0, " Years").otherwise(" Year"))
    age_raw = F.concat(size, F.lit(" years"))
    return p.select(
        "p_partkey",
        to_float(strip_unit(exp_raw, YEARS_UNIT)).alias("experience"),
        int_trunc(strip_unit(age_raw, AGE_UNIT)).alias("age"),
    )


ORACLE_STRIP_UNIT_SIZE = """
SELECT p_partkey, CAST(p_size AS FLOAT) AS experience, CAST(p_size AS INTEGER) AS age
FROM part"""


def rookie_to_zero(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    raw = F.when(F.col("p_size") < 5, F.lit("Rookie")).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(" Years"))
    )
    cleaned = strip_unit(strip_unit(raw, YEARS_UNIT), ROOKIE_WORD, "0")
    return p.select("p_partkey", to_float(cleaned).alias("experience"))


ORACLE_ROOKIE_TO_ZERO = """
SELECT p_partkey, CAST(CASE WHEN p_size < 5 THEN 0 ELSE p_size END AS FLOAT) AS experience
FROM part"""


# --- X6 X7: number extraction (with the kg-digits quirk) ---------------------

def extract_number_q(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    height_raw = F.expr(
        "concat('6-', CAST(p_size % 12 AS STRING), ' (', CASE WHEN p_partkey % 7 = 0 "
        "THEN CAST(1 + p_size % 2 AS STRING) ELSE concat(CAST(1 + p_size % 2 AS STRING), '.', "
        "lpad(CAST(p_size AS STRING), 2, '0')) END, 'm)')"
    )
    weight_raw = F.expr(
        "CASE WHEN p_partkey % 11 = 0 THEN '--' ELSE concat(CAST(150 + p_size AS STRING), "
        "'lb (', CASE WHEN p_partkey % 5 = 0 THEN concat(CAST(60 + p_size AS STRING), '.', "
        "CAST(p_partkey % 10 AS STRING)) ELSE CAST(60 + p_size AS STRING) END, 'kg)') END"
    )
    return p.select(
        "p_partkey",
        null_to_zero(to_float(extract_number(height_raw, METRES_IN_BRACKETS))).alias("height_m"),
        null_to_zero(to_float(extract_number(weight_raw, KILOGRAMS))).alias("weight_kg"),
    )


ORACLE_EXTRACT_NUMBER = """
SELECT p_partkey,
       CASE WHEN p_partkey % 7 = 0 THEN CAST(0 AS FLOAT)
            ELSE CAST(concat(CAST(1 + p_size % 2 AS VARCHAR), '.',
                             lpad(CAST(p_size AS VARCHAR), 2, '0')) AS FLOAT) END AS height_m,
       CAST(CASE WHEN p_partkey % 11 = 0 THEN 0
                 WHEN p_partkey % 5 = 0 THEN p_partkey % 10
                 ELSE 60 + p_size END AS FLOAT) AS weight_kg
FROM part"""


# --- X8: text after the last pipe ---------------------------------------------

def last_segment_q(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    joined = F.concat_ws(" | ", "p_name", "p_brand", "p_type")
    raw = (
        F.when(F.col("p_partkey") % 17 == 0, F.col("p_type"))
        .when(F.col("p_partkey") % 13 == 0, F.concat(joined, F.lit(" |")))
        .otherwise(joined)
    )
    return p.select("p_partkey", last_segment(raw).alias("position"))


ORACLE_LAST_SEGMENT = """
SELECT p_partkey,
       CASE WHEN p_partkey % 17 = 0 THEN p_type
            WHEN p_partkey % 13 = 0 THEN ''
            ELSE concat(' ', p_type) END AS position
FROM part"""


# --- X1 X2: tolerant dates -----------------------------------------------------

def parse_long_date_q(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    raw = (
        F.when(k % 19 == 0, F.lit("--"))
        .when(k % 4 == 0, F.date_format(d, "MMMM d, yyyy"))
        .when(k % 4 == 1, F.date_format(d, "MMM d, yyyy"))
        .when(k % 4 == 2, F.concat(F.upper(F.date_format(d, "MMMM dd, yyyy")), F.lit(" (x)")))
        .otherwise(F.date_format(d, "MMMM dd,  yyyy"))
    )
    return o.select("o_orderkey", parse_long_date(raw).alias("order_date"))


ORACLE_PARSE_LONG_DATE = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date
FROM orders"""


def parse_iso_date_q(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    d = F.col("l_shipdate")
    raw = (
        F.when(ln == 5, F.date_format(d, "yyyyMMdd"))
        .when(ln % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(ln % 3 == 1, F.date_format(d, "yyyy-M-d"))
        .otherwise(F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00")))
    )
    return li.select("l_orderkey", "l_linenumber", parse_iso_date(raw).alias("ship_date"))


ORACLE_PARSE_ISO_DATE = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS ship_date
FROM lineitem"""


# --- P1 P3 P4: select, rename, drop -------------------------------------------

def select_rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier")
    picked = s.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return picked.withColumnsRenamed({"s_name": "supplier_name"}).drop("s_acctbal", "not_there")


ORACLE_SELECT_RENAME_DROP = """
SELECT s_suppkey, s_name AS supplier_name, s_nationkey FROM supplier"""


# --- J1 J2 J3 U1 A1 A2 ------------------------------------------------------

def inner_join_using(spark: SparkSession, sf: str, salt: int | str = 1) -> DataFrame:
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice"
    )
    c = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"
    )
    return inner_join(o, c, "custkey", salt=salt)


def inner_join_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """J1 with the heavy keys split over salted buckets: same rows."""
    return inner_join_using(spark, sf, salt="auto")


ORACLE_INNER_JOIN_USING = """
SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""


def semi_reduce_q(spark: SparkSession, sf: str, salt: int | str = 1) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    urgent = load(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return semi_reduce(li, urgent, "l_orderkey", "o_orderkey", salt=salt)


def semi_reduce_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """J2 with the heavy keys split over salted buckets: same rows."""
    return semi_reduce_q(spark, sf, salt="auto")


ORACLE_SEMI_REDUCE = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""

# Fixed values for the segment lookup queries (a partial code map).
SEGMENT_NAMES = {"BUILDING": "Construction", "MACHINERY": "Industrial"}


def lookup_or_self_q(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    return c.select("c_custkey", map_lookup("c_mktsegment", SEGMENT_NAMES).alias("segment"))


ORACLE_LOOKUP = """
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction'
                         WHEN 'MACHINERY' THEN 'Industrial'
                         ELSE c_mktsegment END AS segment
FROM customer"""


def lookup_udf_q(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    return c.select("c_custkey", lookup_udf(SEGMENT_NAMES)("c_mktsegment").alias("segment"))


def lookup_table_q(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation")
    )
    dim = (
        load(spark, sf, "nation")
        .filter(F.col("n_regionkey") == 1)
        .select(F.col("n_nationkey").cast("string").alias("k"), "n_name")
    )
    return lookup_or_self(c, "nation", dim, "k", "n_name")


ORACLE_LOOKUP_TABLE = """
SELECT c_custkey, COALESCE(n.n_name, CAST(c_nationkey AS VARCHAR)) AS nation
FROM customer LEFT JOIN (SELECT n_nationkey, max(n_name) AS n_name FROM nation
                         WHERE n_regionkey = 1 GROUP BY n_nationkey) n
  ON c_nationkey = n.n_nationkey"""


def distinct_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(load(spark, sf, "orders"), "o_custkey")


ORACLE_DISTINCT_KEYS = "SELECT DISTINCT o_custkey FROM orders"


def row_count_q(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(load(spark, sf, "lineitem"))


ORACLE_ROW_COUNT = "SELECT count(*) AS n FROM lineitem"


def isin_filter_q(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return isin_filter(li, "l_returnflag", ["A", "R"])


ORACLE_ISIN_FILTER = """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')"""


# --- X11: the line under a label, over whole texts ------------------------------

def second_line_q(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    return d.select("doc_id", second_line("text").alias("line2"))


ORACLE_SECOND_LINE = """
SELECT doc_id, string_split(text, chr(10))[2] AS line2 FROM documents"""


# --- A3 X10 U2: word count ------------------------------------------------------

def word_count_q(spark: SparkSession, sf: str) -> DataFrame:
    return word_count(load(spark, sf, "documents"), "text")


ORACLE_WORD_COUNT = """
SELECT word, count(*) AS n
FROM (SELECT unnest(CASE WHEN regexp_full_match(text, ' +') THEN []::VARCHAR[]
                         ELSE string_split(rtrim(text, ' '), ' ') END) AS word
      FROM documents)
GROUP BY word"""


# --- X15 F4: JSON field and quarantine split -----------------------------------

def json_field_q(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    return e.select("event_id", json_field("props", "$.k").alias("k"))


ORACLE_JSON_FIELD = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"


def _captured_events(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    props = F.when(
        F.col("event_id") % 7 == 0, F.expr("substring(props, 1, length(props) - 1)")
    ).otherwise(F.col("props"))
    return e.select("event_id", "event_type", props.alias("props"))


def flag_malformed_q(spark: SparkSession, sf: str) -> DataFrame:
    tagged = flag_malformed(_captured_events(spark, sf), F.try_parse_json("props").isNull())
    status = F.when(F.col("malformed"), F.lit("quarantine")).otherwise(F.lit("good"))
    return tagged.groupBy("event_type", status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


ORACLE_FLAG_MALFORMED = """
SELECT event_type, CASE WHEN event_id % 7 = 0 THEN 'quarantine' ELSE 'good' END AS status,
       count(*) AS n
FROM events GROUP BY ALL"""


def split_malformed_q(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of the split, each with its own sink's name."""
    good, bad = split_malformed(_captured_events(spark, sf), F.try_parse_json("props").isNull())
    return good.withColumn("sink", F.lit("good")).unionByName(bad.withColumn("sink", F.lit("quarantine")))


ORACLE_SPLIT_MALFORMED = """
SELECT event_id, event_type,
       CASE WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1) ELSE props END AS props,
       CASE WHEN event_id % 7 = 0 THEN 'quarantine' ELSE 'good' END AS sink
FROM events"""


# --- F3: rows with too few values ----------------------------------------------

def drop_short_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("values"))
    return drop_short_rows(rows, "values", 2).select("doc_id", F.size("values").alias("n_values"))


ORACLE_DROP_SHORT_ROWS = """
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_values FROM documents
WHERE len(string_split(text, chr(10))) >= 2"""


# --- S3 G7: API payloads -> string rows ----------------------------------------

_PAYLOAD_COLUMNS = ["L_ORDERKEY", "L_LINENUMBER", "RETURNFLAG", "PRICE", "QTY", "BIG"]


def captured_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One captured response per order, with a row per line item: both
    envelope forms (the second with reversed headers), mixed JSON numbers,
    strings and nulls, numbers above 10 million, a surplus value in the rows
    of line 5, and truncated responses for every seventh order."""
    li = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS o", "l_linenumber AS ln", "l_suppkey AS s",
        "CAST(l_orderkey AS STRING) AS ok", "CAST(l_linenumber AS STRING) AS lt",
        "l_returnflag AS rf", "format_string('%.2f', l_extendedprice) AS price",
        "CASE WHEN l_linenumber = 4 THEN 'null' "
        "ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS qty",
        "format_string('%.1f', l_extendedprice * 1000 + 10000000.5) AS big",
        "CASE WHEN l_linenumber = 5 THEN ',0' ELSE '' END AS more")
    rows = li.selectExpr(
        "o", "ln",
        """concat('[', ok, ',', lt, ',"', rf, '","', price, '",', qty, ',', big, more, ']') AS r1""",
        """concat('[', big, ',', qty, ',"', price, '","', rf, '",', lt, ',', ok, more, ']') AS r2""")
    orders = rows.groupBy("o").agg(F.sort_array(F.collect_list(F.struct("ln", "r1", "r2"))).alias("r"))
    return orders.selectExpr(
        "o AS order_key",
        """CASE WHEN o % 2 = 0
             THEN concat('{"resultSet":{"headers":["L_ORDERKEY","L_LINENUMBER","RETURNFLAG","PRICE","QTY","BIG"],',
                         '"rowSet":[', array_join(r.r1, ','), IF(o % 7 = 3, '', ']}}'))
             ELSE concat('{"resultSets":[{"headers":["BIG","QTY","PRICE","RETURNFLAG","L_LINENUMBER","L_ORDERKEY"],',
                         '"rowSet":[', array_join(r.r2, ','), IF(o % 7 = 3, '', ']}]}')) END AS payload""")


def unpack_rowset_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and quarantine of one parse: what a bad row was is told by its
    status, its payload's order and its number of values."""
    flagged = unpack_rowset_flagged(captured_payloads(spark, sf), "payload", _PAYLOAD_COLUMNS,
                                    keep=["order_key"])
    return flagged.select("order_key", "status", *_PAYLOAD_COLUMNS,
                          F.size("values").alias("n_values"),
                          F.startswith("payload", F.lit("{")).alias("kept_payload"))


ORACLE_UNPACK_ROWSET = """
SELECT l_orderkey AS order_key, CASE WHEN l_linenumber = 5 THEN 'over_long' ELSE 'ok' END AS status,
       CASE WHEN l_linenumber <> 5 THEN CAST(l_orderkey AS VARCHAR) END AS "L_ORDERKEY",
       CASE WHEN l_linenumber <> 5 THEN CAST(l_linenumber AS VARCHAR) END AS "L_LINENUMBER",
       CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS "RETURNFLAG",
       CASE WHEN l_linenumber <> 5 THEN printf('%.2f', l_extendedprice) END AS "PRICE",
       CASE WHEN l_linenumber NOT IN (4, 5) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS "QTY",
       CASE WHEN l_linenumber <> 5 THEN printf('%.1f', l_extendedprice * 1000 + 10000000.5) END AS "BIG",
       CASE WHEN l_linenumber = 5 THEN 7 END AS n_values, CAST(NULL AS BOOLEAN) AS kept_payload
FROM lineitem WHERE l_orderkey % 7 <> 3
UNION ALL
SELECT DISTINCT l_orderkey, 'unreadable', NULL, NULL, NULL, NULL, NULL, NULL, NULL, true
FROM lineitem WHERE l_orderkey % 7 = 3"""


# --- S4 X12-X14 P7: stored pages -> positional rows --------------------------

# The driver's pages give two info groups: the title (one block, an odd group)
# and the menu; the menu's blocks are the stats too.
_TITLE, _LI_BLOCK, _H1 = r"<title>(.*?)</title>", r"<li>(.*?)</li>", r"<h1>(.*?)</h1>"


def _named_page_rows(rows: DataFrame) -> DataFrame:
    """Every page's row, with the flag of those that go to quarantine."""
    flagged = flag_malformed(rows, page_row_is_bad("values", len(PLAYER_INFORMATION_HEADER)))
    return flagged.select(*positional_columns("values", PLAYER_INFORMATION_HEADER),
                          F.size("values").alias("n_values"), "malformed")


def page_row_q(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages")
    return _named_page_rows(extract_page_row(
        pages, "html", "page_id", _LI_BLOCK, [_TITLE, _LI_BLOCK], _H1, value_line=None))


def page_row_parsed_q(spark: SparkSession, sf: str) -> DataFrame:
    """S4 through the HTML-parser route (``mapInArrow``): same rows."""
    pages = load(spark, sf, "pages")
    return _named_page_rows(extract_page_row_parsed(
        pages, "html", "page_id", "<li>", ["<title>", "<li>"], "<h1>", value_line=None))


_TEXT = (
    "replace(replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', '', 'g'), "
    "'&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
)


# Rendered text (the parser route): tags removed; the basic entities decoded
# as HTML5 does, where these legacy names need no semicolon (``&amp`` at the
# end of a cut heading is ``&``), ``&amp`` last so ``&amp;lt;`` decodes once;
# HTML whitespace collapsed, then trimmed.
_DECODE_RENDERED = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    "regexp_replace({x}, '<[^>]*>', '', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), "
    "'&quot;?', '\"', 'g'), '&#39;?', '''', 'g'), '&amp;?', '&', 'g')"
)
_RENDERED = "trim(regexp_replace(" + _DECODE_RENDERED + ", '[ \\t\\n\\f\\r]+', ' ', 'g'))"


def _oracle_page_row(text: str = _TEXT) -> str:
    def blocks(tag: str) -> str:
        return (f"list_transform(regexp_extract_all(html, '<{tag}>(.*?)</{tag}>', 1), lambda x: "
                + text.format(x="x") + ")")

    def every_other(group: str, first: int) -> str:
        return f"list_filter({group}, lambda x, i: i % 2 = {first})"

    stats = every_other("li", 0)
    padded = f"list_concat({stats}, list_transform(range(greatest(4 - len({stats}), 0)), lambda x: '--'))"
    info = f"list_concat({every_other('title', 1)}, {every_other('li', 1)})"
    pos = text.format(x="regexp_extract(html, '<h1>(.*?)</h1>', 1)")
    vals = f"list_concat([CAST(page_id AS VARCHAR)], {padded}, {info}, [{pos}])"
    cols = ", ".join(f'v[{i + 1}] AS "{n}"' for i, n in enumerate(PLAYER_INFORMATION_HEADER))
    return (
        f"SELECT {cols}, CAST(len(v) AS INTEGER) AS n_values, "
        f"len(v) > {len(PLAYER_INFORMATION_HEADER)} AS malformed\n"
        f"FROM (SELECT {vals} AS v FROM (SELECT page_id, html, {blocks('li')} AS li, "
        f"{blocks('title')} AS title FROM pages))"
    )


ORACLE_PAGE_ROW = _oracle_page_row()
ORACLE_PAGE_ROW_PARSED = _oracle_page_row(_RENDERED)


# --- registry ---------------------------------------------------------------

QUERIES: dict[str, tuple[Query, str | None]] = {
    "flow_information": (D.flow_information, D.ORACLE_INFORMATION),
    "flow_information_unfilled": (D.flow_information_unfilled, D.ORACLE_INFORMATION_UNFILLED),
    "flow_box": (D.flow_box, D.ORACLE_BOX),
    "flow_leader": (D.flow_leader, D.ORACLE_LEADER),
    "flow_team_leader": (D.flow_team_leader, D.ORACLE_TEAM_LEADER),
    "flow_team_box": (D.flow_team_box, D.ORACLE_TEAM_BOX),
    "type_profile_lineitem": (type_profile_lineitem, ORACLE_TYPE_PROFILE_LINEITEM),
    "int_trunc_orders": (int_trunc_orders, ORACLE_INT_TRUNC_ORDERS),
    "float_bad_to_null": (float_bad_to_null, ORACLE_FLOAT_BAD_TO_NULL),
    "null_to_zero": (null_to_zero_q, ORACLE_NULL_TO_ZERO),
    "strip_unit_size": (strip_unit_size, ORACLE_STRIP_UNIT_SIZE),
    "rookie_to_zero": (rookie_to_zero, ORACLE_ROOKIE_TO_ZERO),
    "extract_number": (extract_number_q, ORACLE_EXTRACT_NUMBER),
    "last_segment": (last_segment_q, ORACLE_LAST_SEGMENT),
    "parse_long_date": (parse_long_date_q, ORACLE_PARSE_LONG_DATE),
    "parse_iso_date": (parse_iso_date_q, ORACLE_PARSE_ISO_DATE),
    "select_rename_drop": (select_rename_drop, ORACLE_SELECT_RENAME_DROP),
    "inner_join_using": (inner_join_using, ORACLE_INNER_JOIN_USING),
    "inner_join_skewed": (inner_join_skewed, ORACLE_INNER_JOIN_USING),
    "semi_reduce": (semi_reduce_q, ORACLE_SEMI_REDUCE),
    "semi_reduce_skewed": (semi_reduce_skewed, ORACLE_SEMI_REDUCE),
    "isin_filter": (isin_filter_q, ORACLE_ISIN_FILTER),
    "lookup_or_self": (lookup_or_self_q, ORACLE_LOOKUP),
    "lookup_udf": (lookup_udf_q, ORACLE_LOOKUP),
    "lookup_table": (lookup_table_q, ORACLE_LOOKUP_TABLE),
    "distinct_keys": (distinct_keys_q, ORACLE_DISTINCT_KEYS),
    "row_count": (row_count_q, ORACLE_ROW_COUNT),
    "word_count": (word_count_q, ORACLE_WORD_COUNT),
    "second_line": (second_line_q, ORACLE_SECOND_LINE),
    "json_field": (json_field_q, ORACLE_JSON_FIELD),
    "flag_malformed": (flag_malformed_q, ORACLE_FLAG_MALFORMED),
    "drop_short_rows": (drop_short_rows_q, ORACLE_DROP_SHORT_ROWS),
    "split_malformed": (split_malformed_q, ORACLE_SPLIT_MALFORMED),
    "unpack_rowset": (unpack_rowset_q, ORACLE_UNPACK_ROWSET),
    "page_row": (page_row_q, ORACLE_PAGE_ROW),
    "page_row_parsed": (page_row_parsed_q, ORACLE_PAGE_ROW_PARSED),
    **R.REPORTS,
    **LANDING_QUERIES,
}

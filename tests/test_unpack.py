"""Payload and page landings (G7, G8) with their negative cases."""

import json
import os

from pyspark.sql import functions as F

from statflow.operators import (
    drop_short_rows,
    extract_page_row,
    name_positional,
    page_row_is_bad,
    payload_headers,
    split_malformed,
    unpack_rowset,
)
from statflow.plans import stat_tables as T
from statflow.sources import read_pages


def _payloads(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


FORM1 = json.dumps({"resultSet": {"headers": ["ID", "NM"], "rowSet": [[1, "x"], [2, None]]}})
FORM2 = ('{"resultSets": [{"headers": ["NM", "ID", "X"], '
         '"rowSet": [["y", 3, {"a": 1}], ["z", 4.50, [1, 2]]]}, '
         '{"headers": ["IGNORED"], "rowSet": [["no"]]}]}')


def test_unpack_both_envelopes(spark):
    out = unpack_rowset(_payloads(spark, [FORM1, FORM2, "not json", '{"resultSet": null}']),
                        columns=["ID", "NM"])
    assert out.dtypes == [("ID", "string"), ("NM", "string")]
    assert sorted(out.collect(), key=lambda r: r.ID) == [
        ("1", "x"), ("2", None), ("3", "y"), ("4.5", "z")]


def test_unpack_discovers_headers(spark):
    df = _payloads(spark, [FORM1, FORM2])
    assert payload_headers(df) == ["ID", "NM", "X"]
    out = unpack_rowset(df)
    assert out.columns == ["ID", "NM", "X"]
    x = {r.ID: r.X for r in out.collect()}
    assert x["1"] is None and json.loads(x["3"]) == {"a": 1} and x["4.5"] == "[1,2]"


def test_unpack_garbage_gives_no_rows(spark):
    assert unpack_rowset(_payloads(spark, ["{", "", "[]"]), columns=["ID"]).count() == 0


def test_land_payload_files(spark, tmp_dir):
    for i, text in enumerate([FORM1, FORM2, "{broken"]):
        with open(os.path.join(tmp_dir, f"p{i}.json"), "w") as f:
            f.write(text)
    out, bad = T.land_payloads(spark, tmp_dir, ["ID", "NM"])
    assert out.count() == 4
    (row,) = bad.collect()
    assert row.status == "unreadable" and row.payload == "{broken" and row.source.endswith("p2.json")


PAGE = """<html><body>
<div class="stat">PPG<br>25.1</div><div class="stat">RPG<br>7.3</div>
<div class="stat">APG<br>8.1</div><div class="stat">PIE<br>0.19</div>
<div class="info top">HEIGHT<br>6'9" (2.06m)</div><div class="info top">x</div>
<div class="info top">WEIGHT<br>250lb (113kg)</div><div class="info top">x</div>
<div class="info top">COUNTRY<br>USA</div><div class="info top">x</div>
<div class="info top">LAST ATTENDED<br>St. Vincent &amp; Mary</div>
<div class="info bottom">AGE<br>39 years</div><div class="info bottom">x</div>
<div class="info bottom">BIRTHDATE<br>December 30, 1984</div><div class="info bottom">x</div>
<div class="info bottom">DRAFT<br>2003 R1 Pick 1</div><div class="info bottom">x</div>
<div class="info bottom">EXPERIENCE<br>20 Years</div>
<p class="position">Los Angeles Lakers | #23 | Forward</p>
</body></html>"""
SHORT_PAGE = '<div class="stat">PPG<br>2.0</div><div class="stat">RPG<br>1.0</div>'
BROKEN_PAGE = '<div class="stat">PPG<br>1</div><div class="stat">RPG</div>'


def test_page_rows(spark):
    pages = spark.createDataFrame(
        [("2544", PAGE), ("1", SHORT_PAGE), ("2", BROKEN_PAGE), ("3", None)],
        "PLAYER_ID string, html string")
    good, bad = T.land_pages(pages)
    rows = {r.PLAYER_ID: r for r in good.collect()}
    lebron = rows["2544"]
    assert (lebron.PPG, lebron.RPG, lebron.APG, lebron.PIE) == ("7.3", "0.19", "--", "--")
    assert lebron.HEIGHT == "6'9\" (2.06m)" and lebron["LAST ATTENDED"] == "St. Vincent & Mary"
    assert lebron.EXPERIENCE == "20 Years"
    assert lebron.POSITION == "Los Angeles Lakers | #23 | Forward"
    # the short page: one stat, padded, no info, empty position.
    short = rows["1"]
    assert (short.PPG, short.RPG, short.APG, short.PIE, short.HEIGHT) == ("1.0", "--", "--", "--", "")
    assert sorted(r.PLAYER_ID for r in bad.collect()) == ["2", "3"]  # broken and missing


def test_page_row_positions_and_short_filter(spark):
    pages = spark.createDataFrame([("k", "<i>a</i><i>b</i><i>c</i><h1>P</h1>")], "id string, html string")
    rows = extract_page_row(pages, "html", "id", "<i>(.*?)</i>", "<i>(.*?)</i>", "<h1>(.*?)</h1>",
                            value_line=None, min_stats=2)
    assert rows.first()["values"] == ["k", "b", "--", "a", "c", "P"]
    named = name_positional(rows, "values", ["ID", "S1", "S2", "I1", "I2", "POS", "EXTRA"])
    assert named.first().asDict() == {"ID": "k", "S1": "b", "S2": "--", "I1": "a", "I2": "c",
                                      "POS": "P", "EXTRA": None}
    assert drop_short_rows(rows, "values", 7).count() == 0
    assert drop_short_rows(rows, "values", 6).count() == 1
    good, bad = split_malformed(rows, page_row_is_bad("values", 5))
    assert good.count() == 0 and bad.count() == 1


def test_read_stored_pages(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "2544.html"), "w") as f:
        f.write(PAGE)
    pages = read_pages(spark, tmp_dir).withColumn(
        "PLAYER_ID", F.regexp_extract("source", r"(\d+)\.html$", 1))
    good, bad = T.land_pages(pages)
    assert good.first().PLAYER_ID == "2544" and bad.count() == 0


NESTED_PAGE = """<div class="stat"><p>PPG</p> <p> 25.1 </p></div>
<div class="stat"><span>RPG</span><br/><b>7.3</b></div>
<div class="info top"><h4>HEIGHT</h4>\n<p>6'9&quot; (2.06m)</p></div>
<p class="position">Lakers | #23 |
 Forward</p>"""


def test_page_blocks_rendered_as_lines(spark):
    from statflow.operators import html_lines

    pages = spark.createDataFrame([("1", NESTED_PAGE)], "PLAYER_ID string, html string")
    good, bad = T.land_pages(pages)
    row = good.first()
    assert bad.count() == 0
    assert (row.PPG, row.RPG, row.HEIGHT) == ("7.3", "--", "6'9\" (2.06m)")
    assert row.WEIGHT == "Lakers | #23 | Forward"  # position follows the values
    texts = spark.createDataFrame([("<p>a</p><p>b  c</p>",), ("x<br>y",), ("",)], "h string")
    assert [r[0] for r in texts.select(html_lines(F.col("h"))).collect()] == ["a\nb c", "x\ny", ""]


DEEP_PAGE = """<div class="stat"><div class="label">PPG</div><div>25.1</div></div>
<div class="stat"><div>RPG</div><div>7.3</div></div>
<div class="stat"><div>APG</div><div>8.1</div></div>
<div class="info top"><div>HEIGHT</div><div>6'9&quot; (2.06m)</div></div>
<section><p class="position">Lakers | #23 | Forward</p></section>"""


def test_parsed_blocks_handle_nested_elements(spark):
    from statflow.operators.htmlblocks import blocks_by_class, extract_page_row_parsed

    found = blocks_by_class(DEEP_PAGE, {"s": ".stat", "i": ".top", "p": ".position"})
    assert found["s"] == ["PPG\n25.1", "RPG\n7.3", "APG\n8.1"]
    assert found["i"] == ["HEIGHT\n6'9\" (2.06m)"] and found["p"] == ["Lakers | #23 | Forward"]
    pages = spark.createDataFrame([("9", DEEP_PAGE), ("10", None)], "id string, html string")
    rows = {r.id: r["values"] for r in extract_page_row_parsed(
        pages, "html", "id", "stat", "top", "position").collect()}
    assert rows["9"] == ["9", "7.3", "--", "--", "--", "6'9\" (2.06m)", "Lakers | #23 | Forward"]
    assert rows["10"] is None  # no page stored: like the regex route, no row values


def test_parsed_and_regex_routes_agree_on_flat_pages(spark):
    from statflow.operators.htmlblocks import extract_page_row_parsed

    pages = spark.createDataFrame([("2544", PAGE), ("1", SHORT_PAGE)], "id string, html string")
    parsed = {r.id: r["values"] for r in extract_page_row_parsed(
        pages, "html", "id", "stat", ["top", "bottom"], "position").collect()}
    good, _ = T.land_pages(pages.withColumnRenamed("id", "PLAYER_ID"))
    regex = {r.PLAYER_ID: [v for v in r if v is not None] for r in good.collect()}
    assert parsed == regex


def test_unpack_checked_quarantines_overlong_rows(spark):
    from statflow.operators import unpack_rowset_checked

    text = json.dumps({"resultSet": {"headers": ["ID", "NM"],
                                     "rowSet": [[1, "x"], [2], [3, "y", "extra"]]}})
    good, bad = unpack_rowset_checked(_payloads(spark, [text]), columns=["ID", "NM"])
    assert sorted(good.collect()) == [("1", "x"), ("2", None)]  # short rows pad with NULL
    (row,) = bad.collect()
    assert row.headers == ["ID", "NM"] and row["values"] == ["3", "y", "extra"]


def test_payload_headers_keep_header_order_across_payloads(spark):
    a = json.dumps({"resultSet": {"headers": ["B", "A"], "rowSet": []}})
    b = json.dumps({"resultSets": [{"headers": ["C", "B", "D"], "rowSet": [[1, 2, 3]]}]})
    assert payload_headers(_payloads(spark, [a, b, "junk"])) == ["B", "C", "A", "D"]


def test_parsed_blocks_skip_script_text():
    from statflow.operators.htmlblocks import blocks_by_class

    page = '<div class="stat">PPG<script>var x = "<div>";</script><br>25.1</div>'
    assert blocks_by_class(page, {"s": ".stat"})["s"] == ["PPG\n25.1"]


def test_header_discovery_refuses_runaway_headers(spark):
    import pytest

    texts = [json.dumps({"resultSet": {"headers": [f"H{i}"], "rowSet": []}}) for i in range(5)]
    with pytest.raises(ValueError, match="distinct headers"):
        payload_headers(_payloads(spark, texts), max_headers=3)


def _probe_page():
    def group(name, pairs):
        blocks = [f'<div class="info {name}">{k}<br>{v}</div>' for k, v in pairs]
        return f'<div class="info {name}">|</div>'.join(blocks)

    top = [("HEIGHT", "h"), ("WEIGHT", "w"), ("COUNTRY", "c"), ("LAST ATTENDED", "l")]
    bottom = [("AGE", "a"), ("BIRTHDATE", "b"), ("DRAFT", "d"), ("EXPERIENCE", "e")]
    stats = "".join(f'<div class="stat">|</div><div class="stat">{s}<br>{i}</div>'
                    for i, s in enumerate(["PPG", "RPG", "APG", "PIE"]))
    return stats + group("top", top) + group("bottom", bottom) + '<p class="position">P</p>'


def test_two_info_groups_of_seven_blocks(spark):
    """4 values + 3 separators in each group: the second starts its own count."""
    pages = spark.createDataFrame([("7", _probe_page())], "PLAYER_ID string, html string")
    want = ["7", "0", "1", "2", "3", "h", "w", "c", "l", "a", "b", "d", "e", "P"]
    for land in (T.land_pages, T.land_pages_parsed):
        good, bad = land(pages)
        assert [list(r) for r in good.collect()] == [want]
        assert bad.count() == 0


PROBES = {
    "ok": FORM1,
    "truncated": '{"resultSet": {"headers": ["ID", "NM"], "rowSet": [[1, "x"]',
    "garbage": "<html>busy</html>",
    "two": FORM1 + "\n" + FORM1,
    "no_rows": '{"resultSet": {"headers": ["ID"]}}',
    "empty": "",
    "long": '{"resultSet": {"headers": ["ID"], "rowSet": [[1, 2], [3], null]}}',
}


def test_unreadable_payloads_are_reported(spark):
    from statflow.operators import unpack_rowset_flagged

    df = spark.createDataFrame([*PROBES.items(), ("null", None)], "name string, payload string")
    rows = unpack_rowset_flagged(df, columns=["ID", "NM"], keep=["name"]).collect()
    got = {}
    for r in rows:
        got.setdefault(r.name, []).append((r.status, r.ID))
    bad = [("unreadable", None)]
    assert got == {"ok": [("ok", "1"), ("ok", "2")], "truncated": bad, "garbage": bad, "two": bad,
                   "no_rows": bad, "empty": bad, "null": bad,
                   "long": [("over_long", None), ("ok", "3"), ("over_long", None)]}
    kept = {r.name: r.payload for r in rows if r.status == "unreadable"}
    assert kept["two"] == PROBES["two"] and kept["null"] is None


def test_json_lines_captures(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "c.jsonl"), "w") as f:
        f.write(FORM1 + "\n" + FORM2 + "\n{broken\n")
    good, bad = T.land_payloads(spark, tmp_dir, ["ID", "NM"], one_per_line=True)
    assert good.count() == 4 and [r.payload for r in bad.collect()] == ["{broken"]
    good, bad = T.land_payloads(spark, tmp_dir, ["ID", "NM"])  # as one response: quarantined whole
    assert good.count() == 0 and bad.count() == 1


def test_numbers_are_written_as_the_csv_landing_does(spark):
    from statflow.functions import int_trunc
    from statflow.functions.strings import plain_number

    numbers = {"1e10": "10000000000.0", "100000000.5": "100000000.5", "12345678.5": "12345678.5",
               "0.0001": "0.0001", "0.00012": "0.00012", "1e-5": "1e-05", "1.5e-7": "1.5e-07",
               "1e16": "1e+16", "9007199254740993.0": "9007199254740992.0", "-1e7": "-10000000.0",
               "-2.5e-4": "-0.00025", "1e300": "1e+300", "4.50": "4.5", "0.0": "0.0", "12": "12",
               "123456789": "123456789"}
    text = '{"resultSet":{"headers":["V"],"rowSet":[%s]}}' % ",".join(f"[{n}]" for n in numbers)
    out = unpack_rowset(_payloads(spark, [text]), columns=["V"])
    assert [r.V for r in out.collect()] == list(numbers.values())
    for n, want in numbers.items():
        assert want == (n if n.lstrip("-").isdigit() else repr(float(n)))
    typed = spark.createDataFrame([("1.23456785E7",)], "v string")
    assert typed.select(int_trunc(plain_number(F.col("v")))).first()[0] == 12345678


def test_parsed_blocks_return_no_pages(spark):
    from pyspark import cloudpickle

    from statflow.operators import htmlblocks

    pages = spark.createDataFrame([("1", DEEP_PAGE)], "id string, html string")
    out = htmlblocks.parsed_blocks(pages, "html", {"s": ".stat"}, ["id"])
    assert out.columns == ["id", "s"]
    # executors need no copy of the package: the parser travels with the job
    assert b"statflow.operators.htmlblocks" in cloudpickle.dumps(htmlblocks.blocks_by_class)
    assert htmlblocks.__name__ in cloudpickle.cloudpickle.list_registry_pickle_by_value()

"""Element paths: against ElementTree on random trees, and what HTML implies."""

import re
import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statflow.operators.htmlpaths import blocks_by_path, parse_path, path_blocks
from statflow.plans import stat_tables as T
from statflow.plans.profiles import PLAYER_INFORMATION_HEADER

TREES = st.recursive(
    st.tuples(st.sampled_from(["div", "span", "section"]), st.just(())),
    lambda inner: st.tuples(st.sampled_from(["div", "span", "section"]), st.lists(inner, max_size=4)),
    max_leaves=25)
STEPS = st.lists(st.tuples(st.sampled_from(["div", "span", "section"]), st.sampled_from([None, 1, 2, 3])),
                 min_size=1, max_size=4)


def render(tree, ids):
    tag, children = tree
    ids.append(len(ids))
    return f"<{tag}>t{ids[-1]} " + "".join(render(c, ids) for c in children) + f"</{tag}>"


def found(html, path):
    (texts,) = blocks_by_path(html, {"x": parse_path(path)}).values()
    return texts


@settings(max_examples=400, deadline=None)
@given(st.lists(TREES, max_size=3), STEPS)
def test_against_element_tree(trees, steps):
    ids = []
    html = "<html><body>" + "".join(render(t, ids) for t in trees) + "</body></html>"
    tail = "/".join(t if n is None else f"{t}[{n}]" for t, n in steps)
    want = [e.text.split()[0] for e in ET.fromstring(html).findall(f"./body/{tail}")]
    got = [t.split()[0] for t in found(html, f"/html/body/{tail}")]
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(TREES, max_size=3), STEPS, STEPS)
def test_several_paths_in_one_pass(trees, first, second):
    html = "<html><body>" + "".join(render(t, []) for t in trees) + "</body></html>"
    paths = {k: "/html/body/" + "/".join(t if n is None else f"{t}[{n}]" for t, n in s)
             for k, s in (("a", first), ("b", second))}
    both = blocks_by_path(html, {k: parse_path(p) for k, p in paths.items()})
    assert both == {k: found(html, p) for k, p in paths.items()}


@pytest.mark.parametrize("html,path,want", [
    ("<div>a</div><div>b</div>", "/html/body/div[2]", ["b"]),  # html and body are implied
    ("<title>t</title><p>a<p>b<div>c</div>", "/html/body/p[2]", ["b"]),
    ("<title>t</title><p>a", "/html/head/title", ["t"]),
    ("<p>a<div>b</div>", "/html/body/p/div", []),  # a div ends the paragraph
    ("<ul><li>a<ul><li>x</ul><li>b</ul>", "/html/body/ul/li[2]", ["b"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "/html/body/table/tr/td", ["1", "2", "3"]),
    ("<div><br>a<br/>b<img src='x'>c</div>", "/html/body/div", ["a\nbc"]),
    ("<div><span/>a</div>", "/html/body/div/span", ["a"]),  # not an empty-element tag in HTML
    ("<div>a</span></p>b</div>c", "/html/body/div", ["ab"]),
    ("<div><b>a</div>c", "/html/body/div", ["a"]),  # the end tag closes what is open inside
    ("<div>a<div>b", "/html/body/div/div", ["b"]),  # unclosed at the end of the page
    ("<div title='</div>'>a</div><!-- <div>x</div> --><div>b</div>", "/html/body/div[2]", ["b"]),
    ("<div><script>'<div>'</script>a</div><DIV>b</DIV>", "/html/body/div", ["a", "b"]),
    ("<div>a</div><p>x</p><div>b</div>", "/html/body/*[2]", ["x"]),
    ("<div><div>L</div><div>v &amp; w</div></div>", "/html/body/div", ["L\nv & w"]),
    ("<html><body><div>a</body></html><div>b</div>", "/html/body/div/div", ["b"]),
    ("", "/html/body/div", []),
])
def test_pages_as_browsers_read_them(html, path, want):
    assert found(html, path) == want


@pytest.mark.parametrize("path", ["", "div", "/div[0]", "//div", "/div[x]", "/div/", "/div[1]x"])
def test_other_paths_are_an_error(path):
    with pytest.raises(ValueError):
        parse_path(path)


def page(stats, top, bottom, position):
    def blocks(values, first):
        sep = "<div></div>"
        own = [f"<div><p>label</p><p>{v}</p></div>" for v in values]
        return "".join(sep + b if first else b + sep for b in own)

    return ("<html><body><div><div>nav</div><div><div>ad</div><div><section><div><section><div>photo</div><div><div>"
            f"<div></div><div><div>{position}</div></div></div></div></section><section><div><div>{blocks(stats, True)}"
            f"</div><div><div></div><div>{blocks(top, False)}</div><div></div><div>{blocks(bottom, False)}</div></div>"
            "</div></section></div></section></div></div></div></body></html>")


def test_land_pages_by_the_sources_paths(spark):
    rows = [("1", page("abcd", "efgh", "ijkl", "<p>G | Guard</p><p>x</p>")), ("2", page("ab", "efgh", "ijkl", "")),
            ("3", page("abcde", "efgh", "ijkl", "")), ("4", None), ("5", page("abcd", "efgh", "ijk", ""))]
    pages = spark.createDataFrame(rows, "PLAYER_ID string, html string").repartition(2)
    good, bad = T.land_pages(pages, stat_pattern=T.PAGE_STAT_PATH, info_pattern=T.PAGE_INFO_PATHS,
                             position_pattern=T.PAGE_POSITION_PATH)
    assert good.columns == list(PLAYER_INFORMATION_HEADER)
    got = {r.PLAYER_ID: list(r)[1:] for r in good.collect()}
    assert got["1"] == [*"abcdefghijkl", "G | Guard"]
    assert got["2"] == [*"ab", "--", "--", *"efghijkl", ""]
    assert got["5"] == [*"abcdefghijk", "", None]  # too few values: the last name stays empty
    assert sorted(r.PLAYER_ID for r in bad.collect()) == ["3", "4"]
    again, _ = T.land_pages_by_path(pages)
    assert sorted(map(str, again.collect())) == sorted(map(str, good.collect()))


def test_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "<p>a", "z")], "id int, html string, a string")
    (row,) = path_blocks(df, "html", {"found": "/html/body/p"}, keep=["id", "a"]).collect()
    assert (row.id, row.a, row.found) == (1, "z", ["a"])


def test_pages_of_one_row_group_are_parsed_by_all_tasks(spark, tmp_dir):
    from statflow.plans.landing_queries import profile_pages

    (spark.range(0, 400, 1, 1).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment")
     .write.parquet(f"{tmp_dir}/customer.parquet"))
    parts = profile_pages(spark, tmp_dir).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in parts) == 400


@pytest.mark.parametrize("html", ["<P>a</P ><DIV>b</div><script><div>x</script><title><div>t</title>",
                                  "<div>a<title>b</div></title></div><textarea><div></textarea>", "<div", "</div", "<div>a</div"])
def test_tags_without_attributes_are_read_as_others(html):
    paths = {"d": parse_path("/html/body/div"), "p": parse_path("/html/body/p"), "s": parse_path("/html/*/*")}
    spaced = re.sub(r"<(/?[A-Za-z]+)>", r"<\1 >", html)  # these take the way of tags with attributes
    assert blocks_by_path(html, paths) == blocks_by_path(spaced, paths)

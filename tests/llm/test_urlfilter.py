"""URL verdicts against plain Python; the filter against the list."""

import random

import pytest
from pyspark.sql import functions as F

from statflow.llm import urlfilter
from statflow.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/x", "HTTP://A.Example.NET/en/x?q#f",
        "http://example.com/de/1", "http://sub.example.com/de/1", "http://notexample.com/de/1",
        "http://x.org/fr/1", "https://www.bad.com/p/", "https://bad.com/p?x=1", "https://bad.com/P", "x://y://z.com/a",
        "http://ÄB.com/ß", "http://net/", "http://net", "http://bad.com/p" + "/q" * 2000]


def brute(url, listed):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    canon = host.removeprefix("www.") + path.rstrip("/") if host else None
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict, canon
    return host, path, None, "block" if canon in listed else "allow", canon


@pytest.mark.parametrize("bits", [1, 16])
def test_verdicts(spark, monkeypatch, bits):
    """One bit per URL makes false positives, which the join removes."""
    monkeypatch.setattr(urlfilter, "BITS_PER_URL", bits)
    rnd = random.Random(2)
    urls = URLS + [f"http://h{rnd.randrange(300)}.com/{rnd.randrange(9)}" for _ in range(600)]
    urls += ["http://bad.com/p"] * 50
    bad = ["https://bad.com/p", None, "nothing"] + [f"https://www.h{i}.com/{i % 9}/?z" for i in range(150)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    pages = pages.withColumn("host", F.lit(1)).withColumn("verdict", F.lit("x"))
    listed = spark.createDataFrame([(u,) for u in bad], "url string")
    canon = {brute(u, set())[4] for u in bad} - {None}
    rows = urlfilter.judge_urls(pages, listed, URL_RULES).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], canon)[:4], urls[r.page_id]
    assert sum(r.verdict == "block" for r in rows) > 50


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    one = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert urlfilter.judge_urls(none, one.select("url"), URL_RULES).collect() == []
    assert [r.verdict for r in urlfilter.judge_urls(one, none.select("url"), URL_RULES).collect()] == ["allow"]


def test_clashing_columns_and_pages_without_host(spark):
    rows = [(i, None if i % 3 else f"http://a{i}.com/x", f"own{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, listed string")
    listed = pages.select("url").filter("page_id = 30")
    out = {r.page_id: r for r in urlfilter.judge_urls(pages, listed, URL_RULES).collect()}
    assert len(out) == 60 and all(out[i].listed == f"own{i}" for i in range(60))
    assert [i for i, r in out.items() if r.verdict == "block"] == [30]
    # rows without a URL are dealt over the filter's blocks
    marked = pages.withColumn("c", F.lit(None).cast("string"))
    block = urlfilter.mark_listed(marked, listed.selectExpr("url AS c"), "c", 8, "hit")
    assert block.count() == 60 and block.filter("hit").count() == 0

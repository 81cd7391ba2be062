"""Archives round trip; the merge equals a sort."""

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statflow.llm import warc


@given(st.lists(st.lists(st.integers(0, 50)), max_size=9))
def test_loser_tree_merges(runs):
    assert list(warc.merge_sorted([sorted(r) for r in runs])) == sorted(x for r in runs for x in r)


def pages(spark, tmp_dir=None):
    rnd = random.Random(3)
    big = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "ß漢😀" * 200
    rows = [(1, "http://b.com/x", big), (2, "http://a.com/", big), (3, "http://www.a.com/#f", "small"),
            (4, "http://a.com/?q", "small"), (5, None, None), (6, "no scheme\r\nX: y", ""), (None, "http://n.com", big),
            (7, "http://c.com/" + "l" * 5000, "y" * 300_000), (7, "http://c.com/" + "l" * 5000, "y" * 300_000)]
    rows += [(i, f"http://h{rnd.randrange(20)}.org/{i % 5}", f"{i % 60:0>150}") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    return rows, df.withColumn("offset", F.lit("x")).withColumn("run", F.lit(1)).withColumn("record", F.lit(2))


def test_round_trip(spark, tmp_dir):
    rows, df = pages(spark)
    got = warc.history(df, f"{tmp_dir}/archive").collect()
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            digest = hashlib.sha256(data).hexdigest()
            first[digest] = min(i, first.get(digest, i))
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        to = first.get(digest)
        to = None if to == i else to
        want.append((i or 0, len(data), digest, "response" if to is None else "revisit", to))
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in got) == sorted(want)
    order = [(r.urlkey, r.captured, -1 if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order)  # globally ordered histories
    assert {r.urlkey for r in got} >= {"com,a)/", "com,b)/x", "com,a)/?q", ""}
    text = spark.read.text(f"{tmp_dir}/archive", wholetext=True).agg(F.sum(F.length("value"))).first()[0]
    assert text > 300_000


def test_no_pages(spark, tmp_dir):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.history(none, f"{tmp_dir}/none").collect() == []

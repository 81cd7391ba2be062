"""Components against all pairs, on both paths of the join."""

import pytest

from statflow.llm import jaccard
from statflow.llm.components import components
from tests.llm import data as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = D.words_of((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("long_level, block", [(1, 5), (1, 512), (7, 512)])
def test_components_equal_brute_force(spark, monkeypatch, long_level, block):
    """With level 1 shared tokens take the path of long lists; small blocks cut
    their groups."""
    monkeypatch.setattr(jaccard, "LONG_LEVEL", long_level)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LIKELIEST", 1)
    texts = D.near_copies()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute(texts)
    kept = {r.doc_id for r in jaccard.distinct_documents(docs).collect()}
    assert kept == {i for i, (n, c) in brute(texts).items() if n == 0 or c == i}


def test_odd_documents(spark):
    docs = D.odd_documents(spark)
    rows = {(r.doc_id, r.n_shingles): r for r in jaccard.jaccard_components(docs).collect()}
    assert len(rows) == len(D.ODD) - 1  # document 6 stands twice
    got = {k[0]: r.component_id for k, r in rows.items()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, None: None, 7: 7, 8: 8, 9: 9}
    assert {k for k in rows if k[0] in (2, 3, 4)} == {(2, 0), (3, 0), (4, 0)} and (8, 1) in rows
    out = jaccard.distinct_documents(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert jaccard.jaccard_components(D.empty_documents(spark)).collect() == []
    assert jaccard.distinct_documents(D.empty_documents(spark)).collect() == []


def test_clashing_columns_keep_their_values(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "")], "doc_id long, text string")
    for name in ("_mark", "mark", "group", "n", "class"):
        docs = docs.withColumn(name, docs["doc_id"] * 10)
    out = jaccard.distinct_documents(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r)[2:] for r in out.collect()) == [(10,) * 5, (30,) * 5]


def test_connected_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (200, 200), (101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_prefix_and_bounds():
    for n in range(1, 400):
        most = n - jaccard.prefix_size(n)  # tokens behind the prefix cannot be enough alone
        assert 100 * most < 75 * n <= 100 * (most + 1)

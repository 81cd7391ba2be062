"""Ranked search against a plain scorer."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from statflow.llm import ranked
from tests.llm import data as D

SPLIT = re.compile("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [t for t in SPLIT.split(low) if t]


def brute(docs, items, k=10):
    tfs = [Counter(terms(t)) for _, t in docs]
    n_docs, n_all = sum(bool(c) for c in tfs), sum(sum(c.values()) for c in tfs)
    df = Counter(t for c in tfs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, own in asked.items():
        scores = []
        for (doc_id, _), c in zip(docs, tfs):
            n, score = sum(c.values()), 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + 90 * n * n_docs // n_all
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return Counter(out)


def found(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def tables(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("block_terms", [ranked.BLOCK_TERMS, 40])
def test_against_brute_force(spark, monkeypatch, block_terms):
    monkeypatch.setattr(ranked, "GROUP_ROWS", 64)
    rnd = random.Random(2)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(30_000)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 90)))) for i in range(700)]
    docs += [(1000 + i, docs[i % 40][1]) for i in range(120)]  # equal scores
    items = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 25)))) for i in range(20)]
    got = found(ranked.search(*tables(spark, docs, items), block_terms=block_terms))
    assert got == brute(docs, items)


def test_odd_documents_and_items(spark):
    docs = [(i, t) for i, t, *_ in D.ODD]
    items = [(1, "Plain WORDS, ßnix – two"), (2, None), (3, "..."), (4, "ünïcode Ünïcode x"), (5, "one"),
             (5, "one spaces"), (6, "absent"), (None, "here")]
    df = D.odd_documents(spark)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for name in ("doc_id", "score", "rank", "places"):
        asked = asked.withColumn(name, asked["item_id"])
    assert found(ranked.search(df, asked)) == brute(docs, items)
    assert ranked.search(D.empty_documents(spark), asked).collect() == []
    assert ranked.search(df, asked.limit(0)).collect() == []


def test_long_items_have_wide_masks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "GROUP_CELLS", 4000)
    rnd = random.Random(7)
    docs = [(i, D.prose(rnd, 60)) for i in range(150)]
    items = [(0, " ".join(f"w{i}" for i in range(300))), (1, "w1 w2")]
    assert found(ranked.search(*tables(spark, docs, items))) == brute(docs, items)


def test_masks_are_left_unevaluated():
    """Masks below the k-th best score are never scored."""
    rnd = random.Random(3)
    n_terms = 12
    rows = [sorted({rnd.randrange(n_terms) for _ in range(rnd.randrange(1, 7))}) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows))), pa.array([50] * len(rows)),
         pa.array([np.array(r, "<u4").tobytes() for r in rows], pa.binary()),
         pa.array([np.ones(len(r), "<u4").tobytes() for r in rows], pa.binary())],
        names=["doc_id", "n", "places", "counts"])
    best = [ranked.Best(10)]
    masks, evaluated = ranked._search(batch, [np.arange(n_terms)], np.arange(1, n_terms + 1) * 100, best,
                                      2000, 100_000)
    assert masks == len({tuple(r) for r in rows})
    assert 0 < evaluated < masks / 4
    assert len(best[0].score) == 10


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(ranked.Block, "hashes", staticmethod(lambda rolled, a, b: np.zeros(len(a), np.uint64)))
    vocabulary = ranked.Vocabulary([b"ab"])
    data = np.frombuffer(b"ab cd AB abc", np.uint8)
    starts, ends = np.array([0, 3, 6, 9]), np.array([2, 5, 8, 12])
    where, term = vocabulary.find(data, starts, ends, np.zeros(4, np.uint64))
    assert where.tolist() == [0, 2] and term.tolist() == [0, 0]

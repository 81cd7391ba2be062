"""Targets, taken words and positions against plain loops."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statflow.llm import mixing
from tests.llm import data as D


def brute_targets(sizes, share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if level * weight[s] >= epochs * sizes[s]}
        if not stopped:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in stopped:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        open_ -= stopped
    return target


def check(rows, sizes):
    target = brute_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        assert sum(t.words for t in r.takes) == r.taken
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 0.5 + 1e-6


def test_odd_documents(spark):
    docs = D.odd_documents(spark).drop("size")
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(D.ODD)
    sizes = defaultdict(int)
    for _, text, _, source in D.ODD:
        sizes[source] += len(D.words_of(text))
    check(rows, dict(sizes))
    assert {r.doc_id: r["size"] for r in rows}[8] == 30_000
    assert mixing.mix(D.empty_documents(spark)).collect() == []
    out = mixing.mixed_documents(D.odd_documents(spark))
    assert out.columns == D.odd_documents(spark).columns
    assert mixing.mixed_documents(D.empty_documents(spark)).count() == 0


def test_many_sources_and_a_hot_one(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"))
    rows = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
    check(rows, dict(sizes))
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    # positions: words taken by time t follow the integral of the schedule
    names = sorted(sizes)
    for i, s in enumerate(names[:3]):
        schedule = mixing.SCHEDULES[i % 3]
        grid = np.linspace(0, 1, 20_001)
        weight = np.interp(grid, np.linspace(0, 1, len(schedule)), schedule)
        share = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
        share /= share[-1]
        takes = sorted((t.position, t.words) for r in rows if r.source == s for t in r.takes)
        before, whole = 0, sum(w for _, w in takes)
        for position, words in takes:
            assert abs(np.interp(position, grid, share) - before / whole) < 2e-3
            before += words


def test_mix_is_written_in_training_order(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("string").alias("source"),
                                   F.lit("a b c d").alias("text"))
    got = mixing.by_position(mixing.mix(docs)).select("position").collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    n = kept.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert abs(n - sum(brute_targets({str(s): 200 for s in range(4)}).values())) <= 2


def test_documents_without_words_stay_in_the_mix(spark):
    """Once each, at a position of the run; also of a source without any word."""
    blank = {2: None, 3: "", 4: " \t\n "}
    docs = spark.createDataFrame(
        [(i, blank.get(i, "a b c"), "s" if i < 20 else "t") for i in range(40)] + [(50, "", "none")],
        "doc_id long, text string, source string")
    rows = mixing.by_position(mixing.mix(docs)).collect()
    found = [(r.doc_id, r.words) for r in rows if r["size"] == 0]
    assert sorted(found) == [(2, 0), (3, 0), (4, 0), (50, 0)]
    assert all(0 <= r.position <= 1 for r in rows)
    kept = {r.doc_id: r.text for r in mixing.mixed_documents(docs).collect()}
    assert {i: kept[i] for i in (*blank, 50)} == {**blank, 50: ""}


def test_clashing_columns_keep_their_values(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                  (F.col("id") % 2).cast("string").alias("source"))
    names = ["size", "position", "words", "taken", "takes", "target", "source_size", "weight"]
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]

"""Held-out accuracy of the classifier and its defined results."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from statflow.llm import toxicity
from tests.llm import data as D

BAD = ["idiot", "moron", "lostra", "vequ"]


def corpus(n=900):
    rnd = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        words = D.prose(rnd, rnd.randrange(5, 200), 300).split()
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                bad = rnd.choice(BAD)
                bad += rnd.choice(["an", "ei", "um", "é"]) if bad in BAD[2:] else rnd.choice(["", ",", "."])
                words[rnd.randrange(len(words))] = bad.upper() if rnd.random() < 0.2 else bad
        docs.append((i, " ".join(words), rnd.choice(["en", "de"]), "s"))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, D.SCHEMA).unionByName(spark.createDataFrame(D.ODD, D.SCHEMA).withColumn(
        "doc_id", F.col("doc_id") + 10_000)).repartition(3)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    return labels, toxicity.classify(df, lab).collect()


def test_held_out_accuracy(scored):
    labels, rows = scored
    y = {i: t for i, _, t in labels}
    held = [r for r in rows if r.doc_id is not None and r.doc_id in y and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id)
    toxic = [r for r in held if y[r.doc_id]]
    clean = [r for r in held if not y[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_defined_results(scored):
    _, rows = scored
    assert len(rows) == 900 + len(D.ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[10_002] == by[10_003] == by[10_004] and len(set(by[10_006])) == 1


def test_without_labels_and_documents(spark):
    docs = D.odd_documents(spark).drop("score")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == len(D.ODD) and {r.score for r in rows} == {0.0}
    one_kind = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.classify(docs, one_kind).collect()} == {1.0}
    assert toxicity.classify(D.empty_documents(spark), one_kind).collect() == []


def test_scoring_makes_room_in_the_worker(spark, scored, monkeypatch):
    """A worker's encoders of a stage before go, and rows go in small slices."""
    import pyarrow as pa

    from statflow.llm import tokens

    tokens.worker_store("encoder_of_test", lambda: [0])
    tokens.worker_store("word_encoder_of_test", lambda: [0])
    kept = tokens.worker_store("other_of_test", lambda: [0])
    tokens.forget_encoders()
    assert tokens.worker_store("encoder_of_test", lambda: [1]) == [1]
    assert tokens.worker_store("word_encoder_of_test", lambda: [1]) == [1]
    assert tokens.worker_store("other_of_test", lambda: [1]) is kept
    tokens.forget_encoders()

    monkeypatch.setattr(toxicity, "SLICE", 1000)
    batch = pa.record_batch([pa.array(["x" * (i % 300) for i in range(500)])], names=["text"])
    parts = list(toxicity._slices([batch, batch.slice(0, 0), batch.slice(7, 1)]))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist() + ["x" * 7]
    assert max(p.num_rows for p in parts) < 20

    # what a slice has scored does not depend on the others
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, D.SCHEMA).coalesce(1)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    small = {r.doc_id: r.score for r in toxicity.classify(df, lab).collect()}
    monkeypatch.setattr(toxicity, "SLICE", 4 << 20)
    assert small == pytest.approx({r.doc_id: r.score for r in toxicity.classify(df, lab).collect()})


def test_fit_takes_an_arrow_table():
    """The sample was collected as rows, each of which stayed in pieces in the driver."""
    import numpy as np
    import pyarrow as pa

    from statflow.llm import toxicity

    words = [np.full((4 + i % 3, toxicity.FEATURES), 5 + i % 2, np.int32).tobytes() for i in range(40)]
    table = pa.table({"key": list(range(40))[::-1], "toxic": pa.array([i % 2 for i in range(40)], pa.int32()),
                      "lang": ["en"] * 40, "words": pa.array(words, pa.binary())})
    model = toxicity.train(table, {0: 20, 1: 20})
    low, high = (toxicity._logit(model, model.rows[np.full((4, toxicity.FEATURES), b)]) for b in (5, 6))
    assert low < high


def test_all_labelled_texts_are_fitted(spark, monkeypatch):
    """3,000 texts of a label were, and none of more than 4,000 words: here no toxic one."""
    import pyarrow as pa

    from statflow.llm.wordhash import blocks

    rnd = random.Random(9)
    docs = [(i, D.prose(rnd, 4), "en") for i in range(3200)]
    for i in range(3200, 3300):
        words = D.prose(rnd, 4100).split()
        if i % 2:
            words[rnd.randrange(len(words))] = "lostra"
        docs.append((i, " ".join(words), "en"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i >= 3200 and i % 2)) for i, *_ in docs], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SHARD", 500_000)
    found = toxicity.labelled(df, labels, F.lit(True))
    assert found.count() == len(docs) and found.select("shard").distinct().count() > 3
    share = {0: 3250, 1: 50}
    model = toxicity.train(found, share)
    # what only long texts have is known, the share of toxic ones is of all texts
    buckets, _ = toxicity.features(next(blocks(pa.array(["lostra w1"]))))
    known = model.rows[buckets]
    assert known.all() and (model.table[known[0], 0] > model.table[known[1], 0] + 0.5).all()
    # neither the order of rows nor the tasks that have them count
    again = toxicity.train(found.repartition(3).sortWithinPartitions(F.col("key").desc()), share)
    assert (again.table == model.table).all() and again.bias == model.bias and again.scale == model.scale


def test_long_texts_are_embedded_in_pieces(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    flat = np.zeros((toxicity._size(51), toxicity.DIM))
    flat[:] = rng.normal(0, 1, flat.shape)
    model = toxicity._model(np.zeros(0, int), flat)
    for n in (1, 6, 7, 8, 30):
        rows = rng.integers(0, 51, (n, toxicity.FEATURES))
        top, at = toxicity._forward(model, rows)
        monkeypatch.setattr(toxicity, "PIECE", 7)
        again, there = toxicity._forward(model, rows)
        monkeypatch.setattr(toxicity, "PIECE", 1 << 16)
        assert np.allclose(top, again) and (top > 0).any()
        places = np.concatenate(at)[top > 0], np.concatenate(there)[top > 0]
        assert (places[0] == places[1]).all()

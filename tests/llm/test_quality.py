"""Measures and verdicts against plain Python."""

import random

from statflow.llm import quality
from tests.llm import data as D


def brute(text):
    w = D.words_of(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if D.words_of(x)]
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    rnd = random.Random(5)
    texts = [t for _, t, *_ in D.ODD]
    texts += [D.prose(rnd, rnd.randrange(80), rnd.choice([3, 10, 500])) for _ in range(150)]
    texts += ["\n".join(rnd.choice(["the same line", "another", " ", "x # y"]) for _ in range(9)) for _ in range(30)]
    texts += ["a a a a", "a b c", "a b c a b c", "a b a b a", "#*$%&|<> the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in quality.judge(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(texts[r.doc_id]), texts[r.doc_id]
        failed = got[0] < 50 or 100 * got[4] > 50 * got[0]
        assert r.base_failed == failed and r.kept == (r.broken == []) and not (failed and r.kept)


def test_rules_and_odd_documents(spark):
    good = "the cat and the dog went to a house in that town. " * 2
    docs = spark.createDataFrame([
        (1, " ".join(f"{good}{i}" for i in range(6))), (2, "x#y " * 60 + good * 3),
        (3, " ".join(f"w{i}" for i in range(90)))], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert "few_repeats" in rows[1].broken
    assert "few_symbols" in rows[2].broken and "stop_words" in rows[3].broken
    odd = D.odd_documents(spark).drop("n_words")
    assert quality.judge(odd).count() == len(D.ODD)
    assert quality.judge(D.empty_documents(spark)).collect() == []
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

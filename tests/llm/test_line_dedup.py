"""Dropped lines against all pairs; the banded distance against the matrix."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statflow.llm import line_dedup
from tests.llm import data as D

SPACE = " \t\n\x0b\x0c\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rnd, text, edits):
    out = list(text)
    for _ in range(edits):
        k, kind = rnd.randrange(len(out)), rnd.random()
        if kind < 0.4:
            out[k] = rnd.choice("abcdé ")
        elif kind < 0.7:
            out.insert(k, rnd.choice("abcdé"))
        else:
            del out[k]
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rnd, rows = random.Random(edits), []
    while len(rows) < 300:
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randrange(24, 40)))
        b = edited(rnd, a, rnd.randrange(5))
        if abs(len(a) - len(b)) <= edits:
            rows.append((a, b))
    rows += [("a b", "a"), ("a", "a b"), ("a  b", "a b"), ("x y z", "x z"), ("a b c", "a b c d"), (" a", "a "),
             ("aa bb cc dd", "aa bx cy dd"), ("one two", "one two"), ("b a b", "b b")]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), edits).alias("w"),
                    line_dedup.similar(F.col("a"), F.col("b"), edits).alias("s"))
    for r in out.collect():
        near = distance(r.a, r.b) <= edits
        shorter = min(len(r.a), len(r.b))
        assert r.s == (distance(r.a, r.b) <= min(edits, shorter // 12) and shorter >= 12), (r.a, r.b)
        assert r.w == near or min(len(r.a), len(r.b)) < 24, (r.a, r.b)


def brute(texts):
    """(repeats, nears) of each document."""
    first = {}
    for i, text in sorted(texts.items()):
        for place, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(SPACE)
            if line:
                first.setdefault(line, (i, place))
    near = {a for a in first for b in first
            if first[b] < first[a] and abs(len(a) - len(b)) <= min(2, min(len(a), len(b)) // 12)
            and a != b and min(len(a), len(b)) >= 12 and distance(a, b) <= min(2, min(len(a), len(b)) // 12)}
    out = {}
    for i, text in texts.items():
        lines = [x.strip(SPACE) for x in text.split("\n")] if text is not None else []
        long = [(p, x) for p, x in enumerate(lines) if x in first]
        repeats = [p for p, x in long if first[x] != (i, p)]
        nears = [p for p, x in long if first[x] == (i, p) and x in near]
        out[i] = (len(lines), repeats, nears)
    return out


def test_lines_against_all_pairs(spark):
    rnd = random.Random(9)
    lines = [D.prose(rnd, rnd.randrange(2, 14)) for _ in range(60)]
    texts = {}
    for i in range(60):
        own = [edited(rnd, rnd.choice(lines), rnd.choice([0, 0, 1, 2, 3, 9])) for _ in range(rnd.randrange(1, 6))]
        texts[i] = "\n".join([*own, "short", " " + rnd.choice(lines) + "\t"])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = brute(texts)
    for r in line_dedup.dedup_lines(docs).collect():
        n, repeats, nears = want[r.doc_id]
        assert (r.n_lines, r.n_repeats, r.n_nears, r.dropped) == (n, len(repeats), len(nears),
                                                                 sorted(repeats + nears))
        kept = [x for p, x in enumerate(texts[r.doc_id].split("\n")) if p not in set(repeats + nears)]
        assert r.text == "\n".join(kept)


def test_odd_documents(spark):
    docs = D.odd_documents(spark)
    rows = line_dedup.dedup_lines(docs, with_text=False).collect()
    assert sorted((r.doc_id or 0, r.n_lines) for r in rows) == sorted(
        (i or 0, 0 if t is None else len(t.split("\n"))) for i, t, *_ in D.ODD)
    # document 6 stands twice; its line and the one of 5 are equal
    assert sorted((r.doc_id or 0, r.dropped) for r in rows if r.dropped) == [(6, [0]), (6, [0])]
    line = "the same long line of text everywhere"
    same = docs.withColumn("text", F.lit(line + "\n" + line))
    out = line_dedup.deduped_documents(same).collect()
    assert [(r.doc_id, r.text) for r in out] == [(None, line)]  # NULL ids come first
    assert line_dedup.deduped_documents(docs).columns == docs.columns
    assert line_dedup.deduped_documents(docs).count() == len(D.ODD) - 2
    assert line_dedup.deduped_documents(D.empty_documents(spark)).count() == 0


def test_a_group_of_near_copies_costs_its_lines(spark, tmp_dir, monkeypatch):
    """Pairs that are verified grow with a group, not with its square."""
    seen = []
    real = line_dedup._verified

    def counted(pairs, kept, edits):
        seen.append(pairs.count())
        return real(pairs, kept, edits)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    rnd = random.Random(3)
    base = D.prose(rnd, 12)
    texts = [(0, base)] + [(i, edited(rnd, base, 1)) for i in range(1, 200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute(dict(texts))
    got = {r.doc_id: r.dropped for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {i: sorted(r + n) for i, (_, r, n) in want.items()}
    assert sum(seen) < 3 * len(texts)


def test_clashing_columns_keep_their_values(spark):
    docs = spark.createDataFrame([(1, "one line here\nx", "a"), (2, "x", "b")], "doc_id long, text string, repeats string")
    for name in ("nears", "_m", "dropped", "n_lines", "_id", "_p", "_first"):
        docs = docs.withColumn(name, F.col("repeats"))
    out = line_dedup.deduped_documents(docs).collect()
    assert [tuple(r) for r in out] == [(1, "one line here\nx", *"aaaaaaaa")]
    (one, two) = sorted(line_dedup.dedup_lines(docs).collect(), key=lambda r: r.doc_id)
    assert (two.repeats, two.nears, two._m, two.n_lines, two.dropped) == ("b", "b", "b", 1, [0])


def test_pipeline_drops_short_repeats(spark):
    """Equal lines of any length go, but blank ones; short lines that are only
    close stay."""
    long = "a line that is long enough to be compared"
    texts = {1: "All rights reserved.\n\nx\nfirst text", 2: " All rights reserved.\t\n\nAll rights reserved!\ny",
             3: f"x\n{long}", 4: f"z\n\n{long}s\n.", 5: "x\n \nAll rights reserved."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    out = corpus_pipeline.without_repeated_lines(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in out} == {
        1: texts[1], 2: "\ny", 3: long, 4: "z\n\n."}


def probe_methods(plan):
    """Bytes of the largest method of every stage that Spark compiles whole."""
    stages = plan._jdf.queryExecution().debug().codegenToSeq()
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_probes_are_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes for every row."""
    kept = spark.range(9).select(F.col("id").alias("_handle"),
                                 F.concat(F.lit("a line of text, number "), "id").alias("_line"))
    length = F.char_length("_line")
    old = kept.select("_handle", F.explode(line_dedup.probe_keys(F.col("_line"), length)))
    new = line_dedup.probes(kept)
    with_limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")  # Spark's default
        assert max(probe_methods(old)) > 8000 > max(probe_methods(new))
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", with_limit)
    assert sorted(new.collect()) == sorted(old.collect())


def test_prefixes_tell_variants_of_a_line_apart(spark):
    """Lines with a few letters put in at different places have about the same
    letters; within two edits no prefix is further apart than twice that."""
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdehilnorst ") for _ in range(360))
    variants = [base[:k] + "hgrl" + base[k:] for k in range(10, 350, 34)]
    rows = [(a, b, False) for a in variants for b in variants if a != b]
    rows += [(a, edited(rnd, a, rnd.randrange(3)), True) for a in variants * 9]
    df = spark.createDataFrame(rows, "a string, b string, near boolean")
    counts, prefixes = line_dedup.letter_counts, line_dedup.prefix_counts
    out = df.select("near", line_dedup.letters_apart(counts(F.col("a")), counts(F.col("b"))).alias("whole"),
                    line_dedup.prefixes_apart(prefixes(F.col("a")), prefixes(F.col("b"))).alias("most")).collect()
    assert all(r.whole <= 4 and r.most <= 4 for r in out if r.near)
    far = [r for r in out if not r.near]
    assert all(r.whole <= 4 for r in far) and sum(r.most <= 4 for r in far) < len(far) / 2


def test_long_lists_of_variants_lose_no_pair(spark, monkeypatch):
    """Answers as by all pairs where lists are long enough to compare prefixes."""
    monkeypatch.setattr(line_dedup, "LONG_LIST", 2)
    rnd, texts = random.Random(5), {}
    base = "".join(rnd.choice("abcdehilnorst ") for _ in range(200))
    for i in range(60):
        k = rnd.randrange(len(base))
        far = base[:k] + rnd.choice(["hgrl", "hgno", "hkbea"]) + base[k:]
        texts[i] = edited(rnd, far, rnd.randrange(4)).strip()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.n_nears + r.n_repeats for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {i: int(any(distance(texts[j], t) <= 2 for j in range(i))) for i, t in texts.items()}


def test_first_letters_are_never_further_apart_than_the_edits(spark):
    """Pairs are given up by their first letters before all are counted: none
    that is close enough may go."""
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("eanr tox") for _ in range(rng.randint(12, 120)))
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "e", "x"])
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    apart = line_dedup.first_letters_apart(F.col("a"), F.col("b"))
    assert df.filter(apart > 2 * line_dedup.EDITS).count() == 0
    far = spark.createDataFrame([("e" * 40, "x" * 40), ("e" * 40, "e" * 8)], "a string, b string")
    assert [r[0] for r in far.select(apart).collect()] == [40, 32]


def test_only_lines_with_white_space_at_an_end_are_trimmed(spark):
    lines = ["", " ", "a", " a", "a\t", "\x0b a b \r", "\u00a0a\u00a0", "a b", "\x0c", "\r\r"]
    got = spark.createDataFrame([(x,) for x in lines], "l string").select(line_dedup._trimmed(F.col("l"))).collect()
    assert [r[0] for r in got] == [x.strip(line_dedup.WHITE_SPACE) for x in lines]


def test_texts_are_not_moved_for_a_result_without_them(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None), (3, "")], "doc_id long, text string")
    judged = line_dedup._judged(docs, "doc_id", "text", 2, with_text=False)
    assert "text" not in judged.columns
    assert {r["doc_id"]: r["_line_n"] for r in judged.collect()} == {1: 2, 2: 0, 3: 1}

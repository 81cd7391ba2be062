"""The registered queries on the driver's tables: against their SQL, or against
brute force where SQL has none."""

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from statflow.llm.queries import QUERIES
from tests.llm import test_aligned, test_jaccard, test_mixing, test_packing, test_tiers
from tools.check_oracles import TABLES, duck_rows, spark_rows

SF = os.environ.get("STATFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in QUERIES.items() if sql))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    scols, srows = spark_rows(QUERIES[name][0](spark, SF))
    dcols, drows = duck_rows(con, QUERIES[name][1])
    assert scols == dcols and Counter(srows) == Counter(drows)


def test_jaccard_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_jaccard"][0](spark, SF).collect()}
    assert got == test_jaccard.brute(texts)


def test_pack_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_pack"][0](spark, SF).collect()
    test_packing.check(rows, texts, 2048)
    bound = -(-sum(r.length for r in rows) // 2048)
    assert test_packing.check_sequences(rows, 2048) <= bound + 3


def test_tiers_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_tiers"][0](spark, SF).collect()
    assert test_tiers.check(rows, texts, test_tiers.tiers.TIERS, test_tiers.tiers.STEP_TOKENS) < 2048


def test_align_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 1500")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in QUERIES["op13_align"][0](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for doc_id, text in texts:  # counts are held against brute force in test_aligned
        a, b, groups, links = test_aligned.plain(text)
        r = got[doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), groups.count(";") + 1, len(links))
        assert r.groups_sha256 == test_aligned.hashlib.sha256(groups.encode()).hexdigest()


def test_mix_query(spark):
    """Each source's taken words come to its target."""
    rows = QUERIES["op1_mix"][0](spark, SF).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    taken, target, size = Counter(), {}, {}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]], size[source[r.doc_id]] = r.target, r.source_size
        assert 0 <= r.taken <= 2 * r["size"]
    assert {r.doc_id for r in rows} == set(source)
    want = test_mixing.brute_targets(size)
    assert all(abs(target[s] - want[s]) < 1e-6 * want[s] + 1e-6 and abs(taken[s] - want[s]) <= 1 for s in size)


def test_ann_query_recall(spark):
    """Recall at 5 against brute force with production parameters, on the
    largest table at hand."""
    folder = SF.replace("sf0.001", "sf0.1")
    if not os.path.isdir(folder):
        folder = SF
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = {}
    for r in QUERIES["op6_ann"][0](spark, folder).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = asked = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[q]
        scores[q] = -2
        best = ids[np.lexsort((ids, -scores))[:5]]
        hits += len(set(best.tolist()) & set(got[int(ids[q])]))
        asked += 5
        for i, s in got[int(ids[q])].items():
            assert abs(s - scores[np.flatnonzero(ids == i)[0]]) < 1e-9
    assert hits >= 0.9 * asked


def test_toxicity_query(spark):
    """Held-out labels: found, and clean texts left alone."""
    folder = SF.replace("sf0.001", "sf0.1")
    folder = folder if os.path.isdir(folder) else SF
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op7_toxicity"][0](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == t for p, t in judged) >= 0.97 * len(judged)


def test_pipeline_stages(spark, tmp_dir):
    """Every stage works on what its predecessor kept, and its decisions hold."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        kept[name] = docs.collect()
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    assert ids["line_dedup"] <= ids["toxicity"] and ids["mixing"] <= ids["ngram_jaccard"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = {i for i, t in labels.items() if t == 0}
    assert len(clean & ids["toxicity"]) >= 0.95 * len(clean)
    lined = [(r.doc_id, r.text) for r in kept["line_dedup"]]
    groups = test_jaccard.brute(lined)
    assert ids["ngram_jaccard"] == {i for i, (n, c) in groups.items() if n == 0 or i == c}
    mixed = Counter()
    for r in kept["mixing"]:
        mixed[r.doc_id] += 1
    assert max(mixed.values()) <= 2
    pieces = kept["packing"]
    tokens = sum(len(test_packing.ids(r.text)) + 1 for r in kept["mixing"])
    assert sum(r.length for r in pieces) == tokens
    test_packing.check_sequences(pieces, 2048)
    assert corpus_pipeline.TOKENIZER == public_tokenizers.path("byte_bpe_50k.json")

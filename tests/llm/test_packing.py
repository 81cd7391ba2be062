"""Packed pieces against the tokenizers library, plans against their bounds."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statflow.llm import packing
from statflow.llm.tokens import Encoder
from tests.llm import data as D

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), Encoder(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zé\n\t 0,.'漢😀\x1f\x0b\xa0s"), max_size=60))
def test_encoder_gives_the_tokenizers_ids(text):
    assert ENCODER.ids(text) == np.array(ids(text), "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encoder_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.ids(text) == np.array(ids(text), "<u4").tobytes()


def check(rows, texts, sequence):
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        own = sorted(by[doc_id], key=lambda r: r.piece)
        data = np.array([*ids(text), 0], "<u4")
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == sequence for r in own[1:]) and sum(r.length for r in own) == len(data)
        for r in own:
            assert zlib.crc32(data[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    check_sequences(rows, sequence)


def check_sequences(rows, sequence):
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= sequence
    return len(at)


def test_odd_documents(spark):
    docs = D.odd_documents(spark)
    rows = packing.pack(docs, PATH, 64).collect()
    texts = {i: t for i, t, *_ in D.ODD}
    once = {(r.doc_id, r.piece): r for r in rows}
    assert len(once) == len(rows) - 1  # document 6 stands twice
    for i, t in texts.items():
        assert sum(r.length for k, r in once.items() if k[0] == i) == len(ids(t)) + 1
    check_sequences(rows, 64)
    assert packing.pack(D.empty_documents(spark), PATH).collect() == []


def test_pieces_and_sequences(spark):
    rnd = random.Random(1)
    texts = {i: D.prose(rnd, rnd.randrange(200)) for i in range(150)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(docs, PATH, 128).collect()
    check(rows, texts, 128)
    total = sum(r.length for r in rows)
    assert check_sequences(rows, 128) <= 1.03 * total / 128 + 1


def plain_best_fit(counts, sequence):
    """Best-fit decreasing, piece by piece."""
    room = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else sequence) - length)
    return len(room)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=25))
def test_plan_uses_every_length_once_and_fits(counts):
    plan = packing.plan(counts, 40)
    used = Counter()
    for lengths, copies in plan:
        assert copies > 0 and sum(lengths) <= 40
        for x in lengths:
            used[x] += copies
    assert used == Counter(counts)
    total = sum(k * n for k, n in counts.items())
    sequences = sum(c for _, c in plan)
    assert sequences >= -(-total // 40)
    assert sequences <= 1.1 * plain_best_fit(counts, 40) + 2


@pytest.mark.parametrize("lengths", [(30, 10), (20, 15, 5), (19, 11, 7, 3)])
def test_exact_complements_leave_no_gap(lengths):
    plan = packing.plan({x: 1000 for x in lengths}, 40)
    assert all(sum(own) == 40 for own, _ in plan)
    assert sum(copies for _, copies in plan) == 1000 * sum(lengths) // 40


def test_a_hot_length(spark):
    rows = [(i, 0, 7 if i % 3 == 0 else 1 + i % 60, i) for i in range(5000)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, length int, ids_crc32 long")
    out = packing.assign(cut, 64).collect()
    assert len(out) == len(rows)
    assert check_sequences(out, 64) <= 1.1 * plain_best_fit(Counter(r[2] for r in rows), 64) + 2


def brute_sums(counts, gap):
    """The fewest available lengths that add up to ``gap``, three at most."""
    for n in (1, 2, 3):
        for own in itertools.combinations_with_replacement(sorted(counts), n):
            if sum(own) == gap and not Counter(own) - Counter(counts):
                return n
    return None


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=8), st.data())
def test_index_of_sums(counts, data):
    """Whatever was used before, the index finds a combination if there is one."""
    free = np.zeros(41, np.int64)
    for n, c in counts.items():
        free[n] = c
    index = packing.Sums(free)
    for gap in data.draw(st.lists(st.integers(1, 40), max_size=12)):
        left = {n: int(free[n]) for n in range(1, 41) if free[n]}
        found = index.complement(gap)
        assert (found and len(found)) == brute_sums(left, gap)
        for n in found or ():
            assert sum(found) == gap
            free[n] -= 1
        assert (free >= 0).all()


def test_order_is_kept(spark):
    rnd = random.Random(4)
    texts = {i: D.prose(rnd, rnd.randrange(150)) for i in range(200)}
    rows = [(i % 150, texts[i % 150], i) for i in range(200)]  # 50 documents stand twice
    docs = spark.createDataFrame(rows, "doc_id long, text string, place long").repartition(6)
    out = packing.pack_in_order(docs, PATH, ["place"], 128, block_pieces=64).collect()
    check_sequences(out, 128)
    assert {(r.doc_id, r.take) for r in out} == {(i, place) for i, _, place in rows}
    assert len({(r.take, r.piece) for r in out}) == len(out)
    for i, text, place in rows:
        assert sum(r.length for r in out if r.take == place) == len(ids(text)) + 1
    # blocks are ranges of the order; sequences of a block follow their first piece
    blocks = {}
    for r in out:
        blocks.setdefault(r.sequence_id >> 20, []).append(r)
    assert all(len(b) <= 64 for b in blocks.values()) and len(blocks) > 3
    ends = [max((r.take, r.piece) for r in blocks[b]) for b in sorted(blocks)]
    starts = [min((r.take, r.piece) for r in blocks[b]) for b in sorted(blocks)]
    assert all(e < s for e, s in zip(ends, starts[1:]))
    for b in blocks.values():
        least = {}
        for r in b:
            least[r.sequence_id] = min(least.get(r.sequence_id, (r.take, r.piece)), (r.take, r.piece))
        assert [v for _, v in sorted(least.items())] == sorted(least.values())


def test_schedules_decide_the_order_of_sequences(spark, tmp_dir, monkeypatch):
    """The mix with its schedules turned round gives the sources' sequences in
    the other order."""
    import corpus_pipeline
    from statflow.llm import mixing

    rnd = random.Random(8)
    rows = [(i, D.prose(rnd, 40), "en", "a" if i % 2 else "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)

    def mean_place(schedules, name):
        real = mixing.mix
        monkeypatch.setattr(mixing, "mix", lambda d, key: real(d, schedules=schedules, key=key))
        corpus_pipeline.mixed(spark, docs, "").write.parquet(f"{tmp_dir}/{name}")
        monkeypatch.setattr(mixing, "mix", real)
        out = corpus_pipeline.packed(spark, spark.read.parquet(f"{tmp_dir}/{name}"), "").collect()
        of = {i: s for i, _, _, s in rows}
        return {s: np.mean([r.take for r in out if of[r.doc_id] == s]) for s in "ab"}

    up, down = [(1.0, 9.0), (9.0, 1.0), (1.0, 1.0)], [(9.0, 1.0), (1.0, 9.0), (1.0, 1.0)]
    one, other = mean_place(up, "up"), mean_place(down, "down")
    assert (one["a"] > one["b"]) != (other["a"] > other["b"])

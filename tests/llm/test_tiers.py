"""Windows of several sizes: ids against the tokenizers library, places against
plain sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statflow.llm import tiers
from statflow.llm.tokens import Memo, WordEncoder
from tests.llm import data as D

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), WordEncoder(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAZ Zéß\n\t 0²,.'sll漢😀\x1f\x0b\xa0ΣİǅA"), max_size=60))
def test_encoder_gives_the_tokenizers_ids(text):
    assert np.frombuffer(ENCODER.ids(text), "<u2").tolist() == ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encoder_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(ENCODER.ids(text), "<u2").tolist() == ids(text)


def test_encoder_special_tokens():
    text = "One <|endoftext|> two <|startoftext|>"
    assert np.frombuffer(ENCODER.ids(text), "<u2").tolist() == ids(text)


def test_memo_is_bounded_and_right():
    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 40 * 300)
    for i in range(2000):
        key = f"k{i % 7}" if i % 2 else f"u{i}"
        assert memo[key] == key * 2
    assert len(memo) + len(memo.old) <= 40
    assert Counter(made)["k1"] <= 3  # in use, so it stays


def check(rows, texts, sizes, step_tokens):
    """Every id once, gapless full windows, even steps; returns the padding."""
    by, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        wide, end = np.array([*ids(text), 1], "<u4"), 0
        for r in sorted(by[doc_id], key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(wide)
            assert r.ids_crc32 == zlib.crc32(wide[end:end + r.length].tobytes())
            end += r.length
        assert end == len(wide)
    return check_windows(windows, sizes, step_tokens)


def check_windows(windows, sizes, step_tokens):
    short, steps = [], defaultdict(list)
    for own in windows.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        tier, = {r.tier for r in own}
        group, = {r.step_group for r in own}
        assert tier in sizes and end <= tier
        steps[tier, group].append(sum(r.length ** 2 for r in own))
        if end < tier:
            short.append((tier, end))
    assert len(short) <= 1 and all(t == sizes[-1] for t, _ in short)
    assert len({g for _, g in steps}) == len(steps)
    for tier in sizes:
        own = [v for (t, _), v in steps.items() if t == tier]
        if own:
            counts = [len(v) for v in own]
            assert max(counts) - min(counts) <= 1 and max(counts) <= max(1, step_tokens // tier)
    return sum(sizes[0] - end for _, end in short)


def test_pieces_windows_and_steps(spark):
    rnd = random.Random(1)
    texts = {i: D.prose(rnd, int(rnd.lognormvariate(4, 1))) for i in range(300)}
    texts[300] = D.prose(rnd, 5000)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = tiers.pack(docs, PATH, (256, 128, 64), 1024).collect()
    assert check(rows, texts, (256, 128, 64), 1024) < 256
    whole = Counter(r.doc_id for r in rows)
    assert sum(n == 1 for n in whole.values()) >= 150  # most documents stay in one piece


def test_odd_documents(spark):
    rows = tiers.pack(D.odd_documents(spark), PATH, (64, 32, 16), 256).collect()
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.length
    want = Counter()
    for i, t, *_ in D.ODD:
        want[i] += len(ids(t)) + 1
    assert lengths == want
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
    check_windows(windows, (64, 32, 16), 256)
    assert tiers.pack(D.empty_documents(spark), PATH).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30))
def test_plan_uses_every_token_once(counts):
    slots = tiers.plan(counts, (64, 32, 16), 256)
    covered = defaultdict(list)
    fill = defaultdict(list)
    for origin, begin, first, last, length, sequence, offset, tier, *_ in slots.tolist():
        for k in range(last - first):
            covered[origin, first + k].append((begin, begin + length))
            fill[sequence + k].append((offset, offset + length, tier))
    assert len(covered) == sum(counts.values())
    for (origin, rank), parts in covered.items():
        assert rank < counts[origin]
        assert [a for a, _ in sorted(parts)] == [0, *(b for _, b in sorted(parts))][:-1]
        assert max(b for _, b in parts) == origin
    short = 0
    for parts in fill.values():
        assert [a for a, *_ in sorted(parts)] == [0, *(b for _, b, _ in sorted(parts))][:-1]
        short += max(b for _, b, _ in parts) < parts[0][2]
    assert short <= 1


def test_steps_are_balanced():
    """Serpentine order against dealing windows out in turn."""
    rnd = random.Random(3)
    slots = tiers.plan(Counter(min(2048, int(rnd.lognormvariate(6, 1.2)) + 1) for _ in range(20_000)))
    costs = defaultdict(int)
    for s in slots.tolist():
        for k in range(s[3] - s[2]):
            place, steps = s[10] + k, s[9]
            turn, step = divmod(place, steps)
            costs[s[7], s[8] + (step if turn % 2 == 0 else steps - 1 - step)] += s[4] ** 2
    top = [v for (t, _), v in costs.items() if t == 2048]
    full = sorted(top)[len(top) // 20:]
    assert max(full) <= 1.25 * min(full)


def test_a_hot_length(spark):
    rows = [(i, 9, 0, 9 if i % 3 == 0 else 1 + i % 60, i, b"\0" * 2 * (9 if i % 3 == 0 else 1 + i % 60))
            for i in range(5000)]
    cut = spark.createDataFrame(rows, tiers.PIECES)
    out = tiers.assign(cut, (64, 32, 16), 1024).collect()
    windows = defaultdict(list)
    for r in out:
        windows[r.sequence_id].append(r)
    check_windows(windows, (64, 32, 16), 1024)
    assert sum(r.length for r in out) == sum(r[3] for r in rows)

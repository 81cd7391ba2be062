"""Captures read by byte ranges against the landing of whole payloads."""

import json
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statflow.operators.unpack import unpack_rowset_flagged
from statflow.sources import captures as C
from statflow.sources import read_payloads


def plain_states(raw):
    """(state, depth) before every byte and at the end, byte by byte."""
    state, depth, out = C.OUTSIDE, 0, []
    for b in raw:
        out.append((state, depth))
        if state == C.ESCAPED:
            state = C.INSIDE
        elif state == C.INSIDE:
            state = {ord('"'): C.OUTSIDE, ord("\\"): C.ESCAPED}.get(b, C.INSIDE)
        elif b == ord('"'):
            state = C.INSIDE
        else:
            depth += {ord("["): 1, ord("{"): 1, ord("]"): -1, ord("}"): -1}.get(b, 0)
    return [*out, (state, depth)]


JSONS = st.recursive(st.one_of(st.none(), st.integers(), st.text('ab"\\[]{},é\n', max_size=8)),
                     lambda x: st.one_of(st.lists(x, max_size=4), st.dictionaries(st.text('a"\\[', max_size=4), x,
                                                                                 max_size=3)), max_leaves=20)


@settings(max_examples=300, deadline=None)
@given(JSONS, st.integers(1, 9), st.booleans())
def test_states_compose_over_any_cut(value, size, ascii_only):
    raw = json.dumps(value, ensure_ascii=ascii_only).encode()
    cuts = [np.frombuffer(raw[i:i + size], np.uint8) for i in range(0, len(raw), size)]
    states = plain_states(raw)
    assert C.compose([C.summary(c) for c in cuts]) == [*(states[i] for i in range(0, len(raw), size)), states[-1]]


TEXTS = ['a"b', "], [", "[[", "\\", '\\"', "}{", "é漢", "", "x,y", "\n"]


def capture(rnd, n_rows, form, indent=None, extra=0):
    headers = ["ID", "NM", "V"]
    rows = []
    for k in range(n_rows):
        row = [k, rnd.choice(TEXTS) + str(k), rnd.choice([None, 1.5, True, 1e10, ["n", [1]], {"a": "]"}])]
        if rnd.random() < 0.1:
            row.append("too long")
        if rnd.random() < 0.1:
            row.pop()
        rows.append(row)
    one = {"name": "Board ]", "headers": headers, "rowSet": rows}
    if form == 1:
        doc = {"resource": 'x"[', "parameters": {"Season": "]}", "list": [1, [2]]}, "resultSet": one}
    elif form == 2:
        doc = {"parameters": {"a": []}, "resultSets": [one, {"headers": ["Z"], "rowSet": [["other"]] * extra}]}
    else:  # rows before the headers
        doc = {"resultSet": dict(reversed(one.items()))}
    return json.dumps(doc, indent=indent, ensure_ascii=rnd.random() < 0.5)


def landed(df, names):
    return sorted((os.path.basename(r.source), r.status, *(r[n] for n in names), str(r.headers), str(r["values"]))
                  for r in df.collect()), names


def same_as_whole(spark, folder, range_bytes, columns):
    whole = unpack_rowset_flagged(read_payloads(spark, folder), "payload", columns, keep=["source"])
    ranged = C.read_capture_rows(spark, folder, columns, range_bytes)
    key = str
    got, want = (sorted(map(key, landed(x, columns)[0])) for x in (ranged, whole))
    assert got == want
    return got


@pytest.mark.parametrize("range_bytes", [40, 300, 1 << 20])
def test_rows_are_those_of_whole_payloads(spark, tmp_dir, range_bytes, monkeypatch):
    monkeypatch.setattr(C, "READ_ON", 16)
    rnd = random.Random(range_bytes)
    docs = [capture(rnd, n, form, indent, extra=2) for n, form, indent in
            [(0, 1, None), (1, 1, None), (12, 1, None), (12, 2, None), (9, 3, 1), (8, 2, 2), (3, 3, None)]]
    good = docs[2]
    docs += [good[:-1], good[:len(good) // 2], good + "{}", good.replace("], [", "] [", 1), "", "[]", "{}",
             "nonsense", '{"resultSet": {"headers": ["ID"], "rowSet": [[1], 5]}}',
             '{"resultSet": {"headers": ["ID"], "rowSet": [[1], [2 3]]}}', '{"resultSet": {"headers": ["ID"]}}',
             '{"resultSet": null}', '{"resultSets": []}']
    for k, text in enumerate(docs):
        with open(os.path.join(tmp_dir, f"{k:02}.json"), "w") as f:
            f.write(text)
    got = same_as_whole(spark, tmp_dir, range_bytes, ["ID", "NM", "V", "ABSENT"])
    assert sum("unreadable" in r for r in got) >= 12 and sum("over_long" in r for r in got) >= 2


def test_columns_are_found(spark, tmp_dir):
    with open(f"{tmp_dir}/a.json", "w") as f:
        f.write(capture(random.Random(1), 5, 1))
    df = C.read_capture_rows(spark, tmp_dir, None, 50)
    assert df.columns == ["source", "ID", "NM", "V", "status", "headers", "values"]
    empty = os.path.join(tmp_dir, "none")
    os.makedirs(empty)
    assert C.read_capture_rows(spark, empty, ["ID"]).collect() == []


def test_one_capture_is_read_by_many_tasks(spark, tmp_dir):
    """A file of 30 ranges: 30 partitions, each with rows of its own."""
    rnd = random.Random(5)
    with open(f"{tmp_dir}/big.json", "w") as f:
        f.write(capture(rnd, 30_000, 1))
    size = os.path.getsize(f"{tmp_dir}/big.json")
    step = size // 30 + 1
    _, ranges, broken = C.capture_ranges(spark, f"{tmp_dir}/big.json", step)
    assert len(ranges) == 30 and not broken
    parts = C._read(spark, C.CaptureParts, ranges, step)
    assert parts.rdd.getNumPartitions() == 30
    counts = parts.filter("is_row").groupBy(parts.file, (parts.at / step).cast("int")).count().collect()
    assert len(counts) == 30 and sum(r["count"] for r in counts) == 30_001  # and one list of the parameters
    got = C.read_capture_rows(spark, tmp_dir, ["ID"], step)
    assert sorted(int(r.ID) for r in got.filter("status = 'ok'").collect() if r.ID) == \
        sorted(int(r.ID) for r in unpack_rowset_flagged(read_payloads(spark, tmp_dir), "payload", ["ID"])
               .filter("status = 'ok'").collect() if r.ID)


def test_a_task_gets_its_own_ranges_only(spark):
    """Many small ranges share tasks, and no task is sent the ranges of all."""
    from pyspark import cloudpickle

    ranges = [[k, f"file:/x/{k:05}", 0, 100, 0, 0, 4] for k in range(5000)]
    assert C.task_bytes(spark, ranges, 100) == 100 * 5000 // (C.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    assert C.task_bytes(spark, ranges, 1 << 20) == 1 << 20
    many = [[0, "file:/x", k << 18, (k + 1) << 18] for k in range(1_000_000)]
    assert C.task_bytes(spark, many, 1 << 18) == C.RANGE_BYTES
    for kind in (C.CaptureStates, C.CaptureParts):
        source = kind({"ranges": json.dumps(ranges), "bytes": "1000"})
        reader = source.reader(None)
        parts = reader.partitions()
        assert len(parts) == 500 and [r for p in parts for r in p.ranges] == ranges
        sent = cloudpickle.dumps((source, reader))
        assert b"/x/00001" not in sent and b"/x/04999" not in sent

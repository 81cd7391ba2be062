"""Snapshot differences against bags, and tables published together."""

import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statflow.operators.changes import apply_changes, snapshot_changes
from statflow.plans import stat_tables as T
from statflow.sources import publish_together, read_tables, vacuum, versions
from statflow.sources.csv import write_csv
from tests import fixtures as X
from tests.test_io import _write_sources

SCHEMA = "k string, j int, v string, w double"
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "", None]), st.sampled_from([1, None]),
                          st.sampled_from(["x", "", None]), st.sampled_from([0.0, 1.5, None])), max_size=7)


def bag(df, names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_applied_changes_give_the_new_table(spark, old_rows, new_rows):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (old_rows, new_rows))
    changes = snapshot_changes(old, new.select("w", "v", "j", "k"), ["k", "j"])
    got = changes.collect()
    by_key = {True: {}, False: {}}
    for is_old, rows in ((True, old_rows), (False, new_rows)):
        for r in rows:
            by_key[is_old].setdefault(r[:2], Counter())[r] += 1
    want = Counter()
    for key in {*by_key[True], *by_key[False]}:
        before, after = by_key[True].get(key), by_key[False].get(key)
        if after is None:
            want[(*key, None, None, "delete")] += 1
        elif before != after:
            for r, n in after.items():
                want[(*r, "insert" if before is None else "update")] += n
    assert Counter(tuple(r) for r in got) == want
    assert bag(apply_changes(old, changes, ["k", "j"]), ["k", "j", "v", "w"]) == Counter(new_rows)


def test_wrong_snapshots(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0)], SCHEMA)
    for bad in (lambda: snapshot_changes(df, df.drop("w"), ["k"]), lambda: snapshot_changes(df, df, []),
                lambda: snapshot_changes(df.withColumnRenamed("v", "change"), df.withColumnRenamed("v", "change"),
                                         ["k"])):
        with pytest.raises(ValueError):
            bad()


def test_equal_tables_have_no_changes_and_one_join(spark):
    df = spark.range(1000).selectExpr("id % 100 AS k", "id AS v")
    changes = snapshot_changes(df, df, ["k"])
    assert changes.count() == 0
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_failed_publication_leaves_all_old_tables(spark, tmp_dir, monkeypatch):
    base, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "tables")
    _write_sources(spark, base)
    assert T.run_daily_published(spark, base, out, concurrent_writes=3) == 0
    old = {n: sorted(map(str, df.collect())) for n, df in read_tables(spark, out).items()}
    assert set(old) == set(T.TABLES.values())
    # the next day has other players; its last table fails
    write_csv(X.frame(spark, X.LEADER_HEADER, X.LEADER_ROWS[:1]).coalesce(1),
              f"{base}/{T.SOURCES['player_leader']}.csv")
    real = versions.Publication.write

    def failing(self, df, name):
        if name == T.TABLES["team_box"]:
            raise OSError("disk")
        real(self, df, name)

    monkeypatch.setattr(versions.Publication, "write", failing)
    with pytest.raises(OSError):
        T.run_daily_published(spark, base, out)
    assert {n: sorted(map(str, df.collect())) for n, df in read_tables(spark, out).items()} == old
    monkeypatch.setattr(versions.Publication, "write", real)
    assert T.run_daily_published(spark, base, out) == 1
    new = read_tables(spark, out)
    assert new[T.TABLES["player_leader"]].count() == 1
    assert read_tables(spark, out, 0)[T.TABLES["player_leader"]].count() == len(X.LEADER_ROWS)  # the day before
    changes = T.daily_changes(spark, out)
    assert changes["team_box"].count() == 0
    assert {r.change for r in changes["player_leader"].collect()} == {"delete"}
    gone = vacuum(spark, out, keep=1)
    assert len(gone) == 5 + 4  # the first day's, and the failed one's
    assert read_tables(spark, out)[T.TABLES["player_leader"]].count() == 1
    with pytest.raises(Exception):
        read_tables(spark, out, 0)


def test_of_two_publications_at_once_the_second_fails(spark, tmp_dir):
    first, second = (versions.Publication(spark, tmp_dir) for _ in range(2))
    first.write(spark.range(1), "t")
    second.write(spark.range(2), "t")
    assert first.commit() == 0
    with pytest.raises(versions.VersionConflict):
        second.commit()
    assert read_tables(spark, tmp_dir)["t"].count() == 1
    assert publish_together(spark, tmp_dir, {"u": spark.range(3)}) == 1
    assert {n: df.count() for n, df in read_tables(spark, tmp_dir).items()} == {"t": 1, "u": 3}
    with open(os.path.join(tmp_dir, "_manifests", "2.json"), "w") as f:
        f.write('{"tables": {"t"')  # broken off while written
    assert set(read_tables(spark, tmp_dir)) == {"t", "u"}


def test_nothing_published(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_tables(spark, tmp_dir)

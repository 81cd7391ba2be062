"""Hot keys: a third of the rows on one key (the case every join must survive)."""

import pytest
from pyspark.sql import functions as F

from statflow.operators import heavy_keys, inner_join, semi_reduce, skew_join


@pytest.fixture()
def skewed(spark):
    """lineitem-like facts where a third of the rows share one customer."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    dim = spark.range(997).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("w"),
    ).unionByName(spark.createDataFrame([("hot", "HOT"), ("hot", "HOT2")], "k string, w string"))
    return facts, dim


def test_heavy_keys_bounded(skewed):
    facts, _ = skewed
    assert [r.k for r in heavy_keys(facts, "k").collect()] == ["hot"]
    assert heavy_keys(facts, "k", min_share=0.5).count() == 0


def _sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n")).collect()]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_skew_join_equals_plain_and_splits_hot_key(spark, skewed, no_broadcast):
    facts, dim = skewed
    plain = inner_join(facts, dim, "k")
    split = skew_join(facts, dim, "k", buckets=32)
    assert split.columns == plain.columns
    assert sorted(split.collect()) == sorted(plain.collect())
    total = plain.count()
    # The plain sort-merge join puts the hot key's 2 x 10,000 rows in one task.
    assert max(_sizes(plain)) >= total // 3
    assert max(_sizes(split)) < total // 4


def test_salted_semi_join_splits_hot_key(spark, skewed, no_broadcast):
    facts, dim = skewed
    plain = semi_reduce(facts, dim, "k")
    split = skew_join(facts, dim, "k", how="left_semi", buckets=32)
    uniform = semi_reduce(facts, dim, "k", salt=32)
    assert sorted(split.collect()) == sorted(plain.collect()) == sorted(uniform.collect())
    assert max(_sizes(plain)) >= 10_000
    assert max(_sizes(split)) < 10_000 and max(_sizes(uniform)) < 10_000


def test_auto_salt_through_flows(spark, skewed, no_broadcast):
    facts, dim = skewed
    assert sorted(inner_join(facts, dim, "k", salt="auto").collect()) == sorted(
        inner_join(facts, dim, "k").collect())
    assert semi_reduce(facts, dim, "k", salt="auto").count() == facts.count()


def test_one_percent_key_is_split_with_many_partitions(spark, no_broadcast):
    """With 400 partitions a key of 1 % is four fair partitions: it is split,
    whichever side holds it, and small keys are not."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        many = spark.range(40_000).select(
            F.when(F.col("id") % 100 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
        few = spark.createDataFrame([(-1, "hot"), (1, "one"), (2, "two")], "k long, w string")
        assert [r.k for r in heavy_keys(many, "k").collect()] == [-1]
        for left, right in ((many, few), (few, many)):
            plain, split = inner_join(left, right, "k"), inner_join(left, right, "k", salt="auto")
            assert sorted(split.collect()) == sorted(plain.collect())
            assert max(_sizes(plain)) >= 400 and max(_sizes(split)) < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_skew_join_runs_nothing_while_it_is_planned(spark, skewed):
    facts, dim = skewed
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    skew_join(facts, dim, "k")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == seen


def _games(spark, days):
    """Two rows (teams) per game, ``days``: game -> date."""
    from tests import fixtures as X

    header = list(X.TEAM_BOX_HEADER)
    rows = []
    for game, day in days.items():
        for team in ("1610", "1611"):
            r = list(X.TEAM_BOX_ROWS[0])
            r[header.index("GAME_ID")], r[header.index("GAME_DATE")] = game, day
            r[header.index("TEAM_ID")] = team
            rows.append(tuple(r))
    return X.frame(spark, header, rows)


@pytest.mark.parametrize("n", [1, 7, 40, 10_000])
def test_newest_games_are_one_answer_whatever_the_partitions(spark, n):
    from statflow.plans.profiles import TEAM_BOX_PROFILE
    from statflow.plans.reports import newest_raw_games

    days = {f"G{i:04d}": "2023-10-24" if i % 10 else f"2023-10-{10 + i % 9:02d}" for i in range(150)}
    days |= {"X1": None, "X2": "--"}
    raw = _games(spark, days)
    order = sorted(((d if d and d[0] == "2" else "", g, t) for g, d in days.items()
                    for t in ("1610", "1611")), reverse=True)[:n]
    for parts in (raw, raw.repartition(7), raw.orderBy("GAME_ID").coalesce(1)):
        got = newest_raw_games(parts, TEAM_BOX_PROFILE, n=n)
        assert sorted(((str(r.GAME_DATE or ""), r.GAME_ID, r.TEAM_ID) for r in got.collect()),
                      reverse=True) == order


def test_newest_games_with_null_keys(spark):
    from statflow.plans.profiles import TEAM_BOX_PROFILE
    from statflow.plans.reports import newest_raw_games

    raw = _games(spark, {f"G{i:02d}": "2023-10-24" for i in range(10)})
    raw = raw.withColumn("GAME_ID", F.when(F.col("GAME_ID") > "G04", F.col("GAME_ID")))
    got = newest_raw_games(raw, TEAM_BOX_PROFILE, n=14).collect()
    assert len(got) == 14 and sum(r.GAME_ID is None for r in got) == 4


def test_leader_board_ranks_everyone(spark):
    """9 players on 50 points, 5 on 40, one without points: nobody is cut."""
    from statflow.plans.reports import leader_board

    rows = [(i, 50) for i in range(9)] + [(i, 40) for i in range(9, 14)] + [(14, None)]
    totals = spark.createDataFrame(rows, "PLAYER_ID int, PTS long")
    got = {r.PLAYER_ID: r.RANK for r in leader_board(totals).collect()}
    assert got == {**{i: 1 for i in range(9)}, **{i: 10 for i in range(9, 14)}, 14: 15}


def test_season_filter(spark):
    from statflow.plans.reports import season_games

    df = spark.createDataFrame([("22023",), ("42023",), ("22022",), (None,)], "SEASON_ID string")
    assert [r[0] for r in season_games(df, "2023-24").collect()] == ["22023"]
    assert [r[0] for r in season_games(df, "2023-24", "Playoffs").collect()] == ["42023"]
    with pytest.raises(ValueError):
        season_games(df, "2023-24", "Summer")


def test_newest_games_sort_no_more_than_the_newest(spark):
    """Ahead of any sort, the scan goes on with the n newest by date and key,
    and all that equal the last of these."""
    from statflow.plans import reports as R

    rows = [(i, f"{2000 + i // 100}-01-01" if i % 7 else None, f"G{i % 50:02d}", None if i % 3 else "1")
            for i in range(1000)] + [(1000, "12009-1-1", "G", "1")]
    df = spark.createDataFrame(rows, "id int, d string, g string, t string").withColumn("d", F.col("d").cast("date"))

    def place(r):
        return tuple((x is None, [-ord(c) for c in x] if x is not None else []) for x in r[1:])

    ordered = sorted(rows[:-1], key=place)
    ordered = [rows[-1], *ordered]
    for n in (1, 2, 10, 60, 900, 1001, 5000):
        want = [r for r in ordered if n > len(ordered) or place(r) <= place(ordered[n - 1]) or r is rows[-1]]
        got = {r.id for r in R._up_to_nth(df, ["d", "g", "t"], n).select("id").collect()}
        assert got == {r[0] for r in (want if n > 1 else [rows[-1]])}, n
    assert R._up_to_nth(df.filter("id < 0"), ["d"], 5).count() == 0

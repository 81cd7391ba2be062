"""Reports the source API computed for the original job (season totals per
player, the points leader board, the newest-N game log), re-expressed as
Spark queries over the typed tables.

Totals are a partial+final hash aggregate. The leader board ranks every
player: ranks are running totals over the different point values, so tied
players, however many, share one row of that computation. The game log keeps
the rows up to the n-th newest date and key, then n of each of a fixed number
of groups of tasks, before it orders what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statflow.functions import parse_iso_date
from statflow.operators.ordered import running_totals
from statflow.operators.profile import Profile, apply_profile
from statflow.plans import driver_flows as D
from statflow.plans.profiles import TEAM_BOX_PROFILE
from statflow.sources.files import load

# The API asks for totals, points ranking and 1000 newest games.
TOTAL_STATS = ("MIN", "PTS", "REB", "AST")
LEADER_STAT = "PTS"
GAME_LOG_ROWS = 1000

# The digit that stands for a season type before the year in a
# SEASON_ID.
SEASON_TYPES = {"Pre Season": "1", "Regular Season": "2", "All Star": "3", "Playoffs": "4"}


def season_games(games: DataFrame, season: str, season_type: str = "Regular Season",
                 column: str = "SEASON_ID") -> DataFrame:
    """Games of one season (``2023-24``) and season type, as the API's Season
    and SeasonType parameters select them."""
    if season_type not in SEASON_TYPES:
        raise ValueError(f"unknown season type {season_type!r}")
    return games.filter(F.col(column) == SEASON_TYPES[season_type] + season[:4])


def season_totals(box: DataFrame, key: str = "PLAYER_ID") -> DataFrame:
    aggs = [F.sum(F.col(c).cast("bigint")).alias(c) for c in TOTAL_STATS]
    return box.groupBy(key).agg(F.count(F.lit(1)).alias("GP"), *aggs)


def leader_board(totals: DataFrame, stat: str = LEADER_STAT) -> DataFrame:
    """All rows with their RANK by ``stat`` (ties share a rank, NULLs come
    last). Rows are counted per value first; a value's rank is one more than
    the rows with larger values, a running total over range partitions. Values
    that hold more than a shuffle partition's share of the rows (0 points, no
    points) are dealt out over salted copies of their rank, so that no task
    reads all rows of a value."""
    buckets = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = totals.groupBy(F.col(stat).alias("__stat")).agg(F.count(F.lit(1)).alias("__n"))
    order = [F.col("__stat").desc_nulls_last()]
    ranks = running_totals(counts, order, {"__before": F.col("__n")})
    fair = ranks.agg(F.sum("__n")).scalar() / buckets
    hot = ranks.filter(F.col("__n") > fair).select(F.col("__stat").alias("__hot"), F.lit(True).alias("__is_hot"))
    # at most one hot value per shuffle partition
    marked = totals.join(F.broadcast(hot), F.col(stat).eqNullSafe(F.col("__hot")), "left").withColumn(
        "__salt", F.when(F.col("__is_hot"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in totals.columns]),
                                                   F.lit(buckets)).cast("int")).otherwise(0))
    copies = F.when(F.col("__n") > fair, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    salted = ranks.select("__stat", "__before", F.explode(copies).alias("__copy"))
    ranked = marked.join(salted, F.col(stat).eqNullSafe(F.col("__stat")) & (F.col("__salt") == F.col("__copy")))
    return ranked.select(*[F.col(f"`{c}`") for c in totals.columns],
                         (F.col("__before") + 1).cast("int").alias("RANK"))


def newest_games(games: DataFrame, n: int = GAME_LOG_ROWS, date: str = "GAME_DATE",
                 key: Sequence[str] = ("GAME_ID", "TEAM_ID")) -> DataFrame:
    """The ``n`` newest rows; rows of a day by ``key``, largest first."""
    return games.orderBy(*_newest_first(F.col(date), key, games.columns)).limit(n)


# Groups of which each keeps n rows before the final order.
NEWEST_GROUPS = 64


def _newest_first(date: Column, key: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """A total order: the last sort key tells apart all rows but equal ones."""
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return [date.desc_nulls_last(), *[F.col(k).desc_nulls_last() for k in key], rest.desc()]


def newest_raw_games(raw: DataFrame, profile: Profile, n: int = GAME_LOG_ROWS,
                     date: str = "GAME_DATE",
                     key: Sequence[str] = ("GAME_ID", "TEAM_ID")) -> DataFrame:
    """Newest-n game log straight from a raw landing: rows are ranked by the
    parsed date alone, n are kept, and only those n are typed. Typing is
    row-local, so this equals typing first and cutting after.

    A first job finds date and key of the n-th newest row (a task keeps n rows
    of these columns alone), so that the scan goes on with n rows and those
    that equal the last of them in date and key. They form ``NEWEST_GROUPS``
    groups by the number of their task, of each of which n are kept, so the
    final order merges at most ``NEWEST_GROUPS`` x n rows.
    """
    order = _newest_first(F.col("__date"), key, raw.columns)
    parsed = _up_to_nth(raw.withColumn("__date", parse_iso_date(date)), ["__date", *key], n).withColumn(
        "__group", F.pmod(F.spark_partition_id(), F.lit(NEWEST_GROUPS)))
    newest = Window.partitionBy("__group").orderBy(*order)
    kept = parsed.withColumn("__place", F.row_number().over(newest)).filter(F.col("__place") <= n)
    top = kept.orderBy(*order).limit(n)
    return apply_profile(top.drop("__date", "__group", "__place"), profile)


def _up_to_nth(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The rows that are not behind the n-th by ``columns`` (largest first,
    NULLs last); all of fewer than n. Runs a job that reads these columns."""
    refs = [F.col(f"`{c}`") for c in columns]
    first = df.select(*refs).orderBy(*[c.desc_nulls_last() for c in refs]).limit(n)
    # as text: a parsed date may lie beyond Python's years
    last = (first.orderBy(*[c.asc_nulls_first() for c in refs]).limit(1)
            .select(*[c.cast("string") for c in refs]).collect())
    if not last:
        return df
    kept = F.lit(True)
    for c, name, text in reversed(list(zip(refs, columns, last[0], strict=True))):
        value = F.lit(text).cast(df.schema[name].dataType)
        before = c.isNotNull() if text is None else F.coalesce(c > value, F.lit(False))
        kept = before | (c.eqNullSafe(value) & kept)
    return df.filter(kept)


def season_totals_q(spark: SparkSession, sf: str) -> DataFrame:
    return season_totals(D.flow_box(spark, sf))


def leader_board_q(spark: SparkSession, sf: str) -> DataFrame:
    return leader_board(season_totals(D.flow_box(spark, sf)))


def newest_games_q(spark: SparkSession, sf: str) -> DataFrame:
    return newest_raw_games(D.team_box_raw(spark, sf), TEAM_BOX_PROFILE)


# The season that the season query asks for.
SEASON = "1995-96"


def season_games_q(spark: SparkSession, sf: str) -> DataFrame:
    kind = (1 + F.col("l_linenumber") % 4).cast("string")
    games = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(kind, F.year("l_shipdate").cast("string")).alias("SEASON_ID"))
    return season_games(games, SEASON)


_SUMS = ", ".join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in TOTAL_STATS)
ORACLE_SEASON_TOTALS = (
    f'SELECT "PLAYER_ID", count(*) AS "GP", {_SUMS}\n'
    f'FROM ({D.ORACLE_BOX}) b\nGROUP BY "PLAYER_ID"'
)
ORACLE_LEADER_BOARD = (
    f'SELECT *, CAST(rank() OVER (ORDER BY "{LEADER_STAT}" DESC NULLS LAST) AS INTEGER) AS "RANK"\n'
    f"FROM ({ORACLE_SEASON_TOTALS}) t"
)
ORACLE_NEWEST_GAMES = (
    f"SELECT * FROM ({D.ORACLE_TEAM_BOX}) g\n"
    f'ORDER BY "GAME_DATE" DESC NULLS LAST, "GAME_ID" DESC, "TEAM_ID" DESC LIMIT {GAME_LOG_ROWS}'
)

ORACLE_SEASON_GAMES = """
SELECT l_orderkey, l_linenumber, '21995' AS "SEASON_ID" FROM lineitem
WHERE l_linenumber % 4 = 1 AND year(l_shipdate) = 1995"""

REPORTS = {
    "season_totals": (season_totals_q, ORACLE_SEASON_TOTALS),
    "leader_board": (leader_board_q, ORACLE_LEADER_BOARD),
    "season_games": (season_games_q, ORACLE_SEASON_GAMES),
    "newest_games": (newest_games_q, ORACLE_NEWEST_GAMES),
}

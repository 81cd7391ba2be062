"""G1-G5 run on raw landings derived from the driver tables.

* player information  <- ``customer`` (one profile page per customer)
* player leader board <- ``supplier`` (one leader row per supplier)
* player box scores   <- ``orders``   (one game row per order, keyed by customer)
* team leader board   <- ``part``
* team box scores     <- ``lineitem`` (one game row per line item)

Each ``*_gens`` list is the raw header of that landing; the same list gives
the DuckDB oracle of the typed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statflow.plans import profiles as P
from statflow.plans import stat_tables as T
from statflow.plans.rawgen import (
    Gen,
    dropped,
    iso_date_gen,
    oracle_select,
    raw_frame,
    same,
    stat_gens,
)
from statflow.sources.files import load

# --- player information from customer --------------------------------------

_C = "c_custkey"
_INFO_GENS = [
    same("PLAYER_ID", f"CAST({_C} AS STRING)"),
    Gen("PPG", "CAST(c_acctbal AS STRING)", "CAST(c_acctbal AS FLOAT)"),
    Gen(
        "RPG",
        f"CASE WHEN {_C} % 10 = 0 THEN '--' ELSE CAST(c_nationkey AS STRING) END",
        f"CAST(CASE WHEN {_C} % 10 = 0 THEN 0 ELSE c_nationkey END AS FLOAT)",
    ),
    Gen(
        "APG",
        f"concat(CAST({_C} % 13 AS STRING), '.5')",
        f"CAST(concat(CAST({_C} % 13 AS STRING), '.5') AS FLOAT)",
    ),
    Gen(
        "PIE",
        f"CASE WHEN {_C} % 6 = 0 THEN NULL "
        f"ELSE concat('0.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) END",
        f"CASE WHEN {_C} % 6 = 0 THEN CAST(0 AS FLOAT) "
        f"ELSE CAST(concat('0.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) AS FLOAT) END",
    ),
    Gen(
        "HEIGHT",
        f"CASE WHEN {_C} % 17 = 0 THEN '--' ELSE concat('6-', CAST({_C} % 12 AS STRING), ' (', "
        f"CASE WHEN {_C} % 9 = 0 THEN '2' "
        f"ELSE concat('1.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) END, 'm)') END",
        f"CASE WHEN {_C} % 17 = 0 OR {_C} % 9 = 0 THEN CAST(0 AS FLOAT) "
        f"ELSE CAST(concat('1.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) AS FLOAT) END",
        "HEIGHT(m)",
    ),
    Gen(
        "WEIGHT",
        f"concat(CAST(150 + {_C} % 100 AS STRING), 'lb (', CASE WHEN {_C} % 8 = 0 "
        f"THEN concat(CAST(60 + {_C} % 50 AS STRING), '.', CAST({_C} % 10 AS STRING)) "
        f"ELSE CAST(60 + {_C} % 50 AS STRING) END, 'kg)')",
        f"CAST(CASE WHEN {_C} % 8 = 0 THEN {_C} % 10 ELSE 60 + {_C} % 50 END AS FLOAT)",
        "WEIGHT(kg)",
    ),
    Gen(
        "COUNTRY",
        "CASE c_nationkey % 3 WHEN 0 THEN 'USA' WHEN 1 THEN 'FR' ELSE NULL END",
        "CASE c_nationkey % 3 WHEN 0 THEN 'United States' WHEN 1 THEN 'FR' ELSE NULL END",
    ),
    same("LAST ATTENDED", "c_mktsegment", "LAST_ATTENDED"),
    Gen(
        "AGE",
        f"concat(CAST(20 + {_C} % 20 AS STRING), ' years')",
        f"CAST(20 + {_C} % 20 AS INTEGER)",
    ),
    Gen(
        "BIRTHDATE",
        f"CASE WHEN {_C} % 23 = 0 THEN '--' "
        f"WHEN {_C} % 2 = 0 THEN date_format(date_add(DATE'1960-01-01', "
        f"CAST({_C} * 37 % 15000 AS INT)), 'MMMM d, yyyy') "
        f"WHEN {_C} % 3 = 0 THEN concat(upper(date_format(date_add(DATE'1960-01-01', "
        f"CAST({_C} * 37 % 15000 AS INT)), 'MMMM dd, yyyy')), ' (x)') "
        f"ELSE date_format(date_add(DATE'1960-01-01', CAST({_C} * 37 % 15000 AS INT)), "
        f"'MMM d, yyyy') END",
        f"CASE WHEN {_C} % 23 = 0 THEN NULL "
        f"ELSE DATE '1960-01-01' + CAST({_C} * 37 % 15000 AS INTEGER) END",
    ),
    same("DRAFT", "c_name"),
    Gen(
        "EXPERIENCE",
        f"CASE WHEN {_C} % 7 = 0 THEN '--' WHEN {_C} % 5 = 0 THEN 'Rookie' "
        f"WHEN {_C} % 5 = 1 THEN '1 Year' ELSE concat(CAST({_C} % 20 AS STRING), ' Years') END",
        f"CAST(CASE WHEN {_C} % 7 = 0 THEN NULL WHEN {_C} % 5 = 0 THEN 0 "
        f"WHEN {_C} % 5 = 1 THEN 1 ELSE {_C} % 20 END AS FLOAT)",
    ),
    Gen(
        "POSITION",
        f"CASE WHEN {_C} % 11 = 0 THEN c_mktsegment "
        f"ELSE concat(c_name, ' | #', CAST({_C} % 99 AS STRING), ' | ', c_mktsegment) END",
        f"CASE WHEN {_C} % 11 = 0 THEN c_mktsegment ELSE concat(' ', c_mktsegment) END",
    ),
]

# The older, unscheduled job: same landing, no NULL -> 0 fills, no country map.
_UNFILLED = {
    "RPG": f"CAST(CASE WHEN {_C} % 10 = 0 THEN NULL ELSE c_nationkey END AS FLOAT)",
    "PIE": f"CASE WHEN {_C} % 6 = 0 THEN NULL "
           f"ELSE CAST(concat('0.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) AS FLOAT) END",
    "HEIGHT": f"CASE WHEN {_C} % 17 = 0 OR {_C} % 9 = 0 THEN NULL "
              f"ELSE CAST(concat('1.', lpad(CAST({_C} % 100 AS STRING), 2, '0')) AS FLOAT) END",
    "COUNTRY": "CASE c_nationkey % 3 WHEN 0 THEN 'USA' WHEN 1 THEN 'FR' ELSE NULL END",
}
_INFO_UNFILLED_GENS = [
    Gen(g.name, g.raw, _UNFILLED[g.name], g.out) if g.name in _UNFILLED else g for g in _INFO_GENS
]

# --- player leader board from supplier --------------------------------------

_S = "s_suppkey"
_LEADER_HEADER = (
    "PLAYER_ID", "RANK", "PLAYER", "TEAM", "GP", "MIN", "FGM", "FGA", "FG_PCT",
    "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB",
    "AST", "STL", "BLK", "TOV", "PF", "PTS", "EFF", "AST_TOV", "STL_TOV",
)


def _leader_gens() -> list[Gen]:
    stats = stat_gens(_LEADER_HEADER, P.PLAYER_LEADER_INTS, P.PLAYER_LEADER_FLOATS, _S)
    fixed = {
        "PLAYER_ID": same("PLAYER_ID", f"CAST({_S} AS STRING)"),
        "RANK": Gen("RANK", f"CAST({_S} + 1 AS STRING)", f"CAST({_S} + 1 AS INTEGER)"),
        "PLAYER": dropped("PLAYER", "s_name"),
        "TEAM": dropped("TEAM", "CAST(s_nationkey AS STRING)"),
        "GP": same("GP", "CAST(s_nationkey + 60 AS STRING)"),
    }
    return [fixed.get(h) or stats[h] for h in _LEADER_HEADER]


_LEADER_GENS = _leader_gens()

# --- player box scores from orders ------------------------------------------

_O = "o_orderkey"
_BOX_HEADER = (
    "SEASON_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_NAME", "GAME_ID", "GAME_DATE",
    "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
    "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS",
    "PLUS_MINUS", "FANTASY_PTS", "VIDEO_AVAILABLE",
)


def _box_gens() -> list[Gen]:
    stats = stat_gens(_BOX_HEADER, P.PLAYER_BOX_INTS, P.PLAYER_BOX_FLOATS, _O)
    fixed = {
        "SEASON_ID": dropped("SEASON_ID", "'22023'"),
        "PLAYER_ID": same("PLAYER_ID", "CAST(o_custkey AS STRING)"),
        "PLAYER_NAME": dropped("PLAYER_NAME", "concat('P', CAST(o_custkey AS STRING))"),
        "TEAM_NAME": dropped("TEAM_NAME", "o_orderpriority"),
        "GAME_ID": same("GAME_ID", f"CAST({_O} AS STRING)"),
        "GAME_DATE": iso_date_gen("GAME_DATE", "o_orderdate", _O),
        "VIDEO_AVAILABLE": dropped("VIDEO_AVAILABLE", "'1'"),
    }
    return [fixed.get(h) or stats[h] for h in _BOX_HEADER]


_BOX_GENS = _box_gens()

# --- team leader board from part --------------------------------------------

_PK = "p_partkey"
_TEAM_LEADER_HEADER = (
    "TEAM_ID", "TEAM_NAME", "GP", "W", "L", "W_PCT", "MIN", "FGM", "FGA", "FG_PCT",
    "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB",
    "AST", "TOV", "STL", "BLK", "BLKA", "PF", "PFD", "PTS", "PLUS_MINUS",
) + P.TEAM_LEADER_DROP


def _team_leader_gens() -> list[Gen]:
    stats = stat_gens(_TEAM_LEADER_HEADER, P.TEAM_LEADER_INTS, P.TEAM_LEADER_FLOATS, _PK)
    fixed = {
        "TEAM_ID": same("TEAM_ID", f"CAST({_PK} AS STRING)"),
        "TEAM_NAME": same("TEAM_NAME", "p_name"),
    }
    for i, name in enumerate(P.TEAM_LEADER_DROP):
        fixed[name] = dropped(name, f"CAST(({_PK} + {i}) % 30 + 1 AS STRING)")
    return [fixed.get(h) or stats[h] for h in _TEAM_LEADER_HEADER]


_TEAM_LEADER_GENS = _team_leader_gens()

# --- team box scores from lineitem ------------------------------------------

_L = "(l_orderkey * 16 + l_linenumber)"
_TEAM_BOX_HEADER = (
    "SEASON_ID", "TEAM_ID", "TEAM_NAME", "GAME_ID", "GAME_DATE", "MIN", "FGM",
    "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB",
    "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS",
    "VIDEO_AVAILABLE",
)


def _team_box_gens() -> list[Gen]:
    stats = stat_gens(_TEAM_BOX_HEADER, P.TEAM_BOX_INTS, P.TEAM_BOX_FLOATS, _L)
    fixed = {
        "SEASON_ID": dropped("SEASON_ID", "'22023'"),
        "TEAM_ID": same("TEAM_ID", "CAST(l_suppkey AS STRING)"),
        "TEAM_NAME": dropped("TEAM_NAME", "l_returnflag"),
        "GAME_ID": same(
            "GAME_ID", "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))"
        ),
        "GAME_DATE": iso_date_gen("GAME_DATE", "l_shipdate", _L),
        "VIDEO_AVAILABLE": dropped("VIDEO_AVAILABLE", "'0'"),
    }
    return [fixed.get(h) or stats[h] for h in _TEAM_BOX_HEADER]


_TEAM_BOX_GENS = _team_box_gens()


# --- raw landings ------------------------------------------------------------

def info_raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(load(spark, sf, "customer"), _INFO_GENS)


def leader_raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(load(spark, sf, "supplier"), _LEADER_GENS)


def box_raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(load(spark, sf, "orders"), _BOX_GENS)


def team_leader_raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(load(spark, sf, "part"), _TEAM_LEADER_GENS)


def team_box_raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_frame(load(spark, sf, "lineitem"), _TEAM_BOX_GENS)


# --- the flows ---------------------------------------------------------------

def flow_information(spark: SparkSession, sf: str) -> DataFrame:
    return T.player_information(info_raw(spark, sf), leader_raw(spark, sf))


def flow_information_unfilled(spark: SparkSession, sf: str) -> DataFrame:
    return T.player_information(
        info_raw(spark, sf), leader_raw(spark, sf), country_codes={}, fill_missing=False
    )


def flow_box(spark: SparkSession, sf: str) -> DataFrame:
    return T.player_box_scores(box_raw(spark, sf), flow_information(spark, sf))


def flow_leader(spark: SparkSession, sf: str) -> DataFrame:
    return T.player_leader(leader_raw(spark, sf))


def flow_team_leader(spark: SparkSession, sf: str) -> DataFrame:
    return T.team_leader(team_leader_raw(spark, sf))


def flow_team_box(spark: SparkSession, sf: str) -> DataFrame:
    return T.team_box_scores(team_box_raw(spark, sf))


# --- oracles -----------------------------------------------------------------

ORACLE_INFORMATION = (
    oracle_select(
        [*_INFO_GENS, Gen("PLAYER_NAME", "", "s_name")],
        "customer JOIN supplier ON c_custkey = s_suppkey",
    )
)
ORACLE_INFORMATION_UNFILLED = oracle_select(
    [*_INFO_UNFILLED_GENS, Gen("PLAYER_NAME", "", "s_name")],
    "customer JOIN supplier ON c_custkey = s_suppkey",
)
_SURVIVORS = "SELECT c_custkey FROM customer JOIN supplier ON c_custkey = s_suppkey"
ORACLE_BOX = oracle_select(_BOX_GENS, "orders", f"o_custkey IN ({_SURVIVORS})")
ORACLE_LEADER = oracle_select(_LEADER_GENS, "supplier")
ORACLE_TEAM_LEADER = oracle_select(_TEAM_LEADER_GENS, "part")
ORACLE_TEAM_BOX = oracle_select(_TEAM_BOX_GENS, "lineitem")

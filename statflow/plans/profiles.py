"""Type profiles of the five statistics tables.

Each profile is data: which raw string columns become INT / FLOAT / DATE,
which are cleaned first, NULL-filled, renamed or dropped. Columns a profile
does not name (unknown API headers) pass through as strings.
"""

from __future__ import annotations

from statflow.functions import extract_number, last_segment, strip_unit
from statflow.functions.strings import (
    AGE_UNIT,
    KILOGRAMS,
    METRES_IN_BRACKETS,
    ROOKIE_WORD,
    YEARS_UNIT,
)
from statflow.operators.profile import Profile, Rule, floats, ints
from statflow.operators.relate import map_lookup

# ---------------------------------------------------------------------------
# Table headers, typed column lists, dropped columns and the
# country-code mapping of the statistics tables, in source order.
# ---------------------------------------------------------------------------

PLAYER_INFORMATION_HEADER = (
    "PLAYER_ID", "PPG", "RPG", "APG", "PIE", "HEIGHT", "WEIGHT", "COUNTRY",
    "LAST ATTENDED", "AGE", "BIRTHDATE", "DRAFT", "EXPERIENCE", "POSITION",
)
PLAYER_INFORMATION_FLOATS = ("RPG", "PPG", "APG", "PIE")
IOC_TO_COUNTRY = {"USA": "United States"}

PLAYER_BOX_INTS = (
    "MIN", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB",
    "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS", "FANTASY_PTS",
)
PLAYER_BOX_FLOATS = ("FG_PCT", "FG3_PCT", "FT_PCT")
PLAYER_BOX_DROP = ("SEASON_ID", "PLAYER_NAME", "TEAM_NAME", "VIDEO_AVAILABLE")

PLAYER_LEADER_INTS = (
    "MIN", "RANK", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB",
    "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "EFF",
)
PLAYER_LEADER_FLOATS = ("FG_PCT", "FG3_PCT", "FT_PCT", "AST_TOV", "STL_TOV")
PLAYER_LEADER_DROP = ("PLAYER", "TEAM")

TEAM_LEADER_INTS = (
    "MIN", "GP", "W", "L", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB",
    "DREB", "REB", "AST", "TOV", "STL", "BLK", "BLKA", "PF", "PFD", "PTS",
    "PLUS_MINUS",
)
TEAM_LEADER_FLOATS = ("W_PCT", "FG_PCT", "FG3_PCT", "FT_PCT")
TEAM_LEADER_DROP = (
    "GP_RANK", "W_RANK", "L_RANK", "W_PCT_RANK", "MIN_RANK", "FGM_RANK",
    "FGA_RANK", "FG_PCT_RANK", "FG3M_RANK", "FG3A_RANK", "FG3_PCT_RANK",
    "FTM_RANK", "FTA_RANK", "FT_PCT_RANK", "OREB_RANK", "DREB_RANK", "REB_RANK",
    "AST_RANK", "TOV_RANK", "STL_RANK", "BLK_RANK", "BLKA_RANK", "PF_RANK",
    "PFD_RANK", "PTS_RANK", "PLUS_MINUS_RANK",
)

TEAM_BOX_INTS = (
    "MIN", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB",
    "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS",
)
TEAM_BOX_FLOATS = ("FG_PCT", "FG3_PCT", "FT_PCT")
TEAM_BOX_DROP = ("SEASON_ID", "TEAM_NAME", "VIDEO_AVAILABLE")

# Output names of renamed columns.
PLAYER_INFORMATION_RENAME = {
    "HEIGHT": "HEIGHT(m)",
    "WEIGHT": "WEIGHT(kg)",
    "LAST ATTENDED": "LAST_ATTENDED",
}
LEADER_NAME_COLUMN, PLAYER_NAME_COLUMN = "PLAYER", "PLAYER_NAME"
PLAYER_KEY = "PLAYER_ID"


def player_information_profile(
    country_codes: dict[str, str] | None = None, fill_missing: bool = True
) -> Profile:
    """Profile of the player-information landing. The scheduled job fills
    NULL stats with 0 and maps country codes; its older unscheduled variant
    did neither (``fill_missing=False, country_codes={}``)."""
    codes = IOC_TO_COUNTRY if country_codes is None else country_codes
    fill = 0 if fill_missing else None
    rules: dict[str, Rule] = {
        "BIRTHDATE": Rule("long_date"),
        **floats(PLAYER_INFORMATION_FLOATS, fill=fill),
        "EXPERIENCE": Rule(
            "float",
            pre=(lambda c: strip_unit(c, YEARS_UNIT), lambda c: strip_unit(c, ROOKIE_WORD, "0")),
        ),
        "AGE": Rule("int", pre=(lambda c: strip_unit(c, AGE_UNIT),)),
        "HEIGHT": Rule("float", pre=(lambda c: extract_number(c, METRES_IN_BRACKETS),), fill=fill),
        "WEIGHT": Rule("float", pre=(lambda c: extract_number(c, KILOGRAMS),), fill=fill),
        "POSITION": Rule(pre=(last_segment,)),
        "COUNTRY": Rule(pre=(lambda c: map_lookup(c, codes),)),
    }
    return Profile(rules=rules, rename=PLAYER_INFORMATION_RENAME)


PLAYER_BOX_PROFILE = Profile(
    rules={"GAME_DATE": Rule("iso_date"), **ints(PLAYER_BOX_INTS), **floats(PLAYER_BOX_FLOATS)},
    drop=PLAYER_BOX_DROP,
)
PLAYER_LEADER_PROFILE = Profile(
    rules={**ints(PLAYER_LEADER_INTS), **floats(PLAYER_LEADER_FLOATS)},
    drop=PLAYER_LEADER_DROP,
)
TEAM_LEADER_PROFILE = Profile(
    rules={**ints(TEAM_LEADER_INTS), **floats(TEAM_LEADER_FLOATS)},
    drop=TEAM_LEADER_DROP,
)
TEAM_BOX_PROFILE = Profile(
    rules={"GAME_DATE": Rule("iso_date"), **ints(TEAM_BOX_INTS), **floats(TEAM_BOX_FLOATS)},
    drop=TEAM_BOX_DROP,
)

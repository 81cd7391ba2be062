"""Hand-made raw landings in the formats the source API and pages produce
(all values strings; one extra unknown column per table to test pass-through)."""

from statflow.plans.profiles import PLAYER_INFORMATION_HEADER, TEAM_LEADER_DROP

INFO_ROWS = [
    ("201", "25.1", "7.3", "8.1", "0.19", '6\'9" (2.06m)', "250lb (113kg)", "USA",
     "St. Vincent-St. Mary HS (OH)", "39 years", "December 30, 1984", "2003 R1 Pick 1",
     "20 Years", "Lakers | #23 | Forward"),
    ("202", "--", None, "3.0", "NaN", '6\'0" (1m)', "200lb (90.7kg)", "FR", "France",
     "20 years", "January 4, 2004", "2023 R1 Pick 1", "Rookie", "Center"),
    ("203", "10", "5", "2", "0.1", "--", "--", None, "Duke", "25 years", "--",
     "Undrafted", "1 Year", "Spurs | #1 |"),
    ("204", "1.0", "1.0", "1.0", "0.05", '6\'5" (1.96m)', "210lb (95kg)", "USA", "UCLA",
     "30 years", "Jan 5, 1994", "2015 R2 Pick 40", "--", "Guard"),
]
INFO_HEADER = PLAYER_INFORMATION_HEADER

LEADER_HEADER = (
    "PLAYER_ID", "RANK", "PLAYER", "TEAM", "GP", "MIN", "FGM", "FGA", "FG_PCT", "FG3M",
    "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK",
    "TOV", "PF", "PTS", "EFF", "AST_TOV", "STL_TOV", "TEAM_ID",
)


def leader_row(pid, rank, name):
    stats = ["71", "2504.5", "685", "1269", "0.54", "40", "98", "0.408", "387", "506", "0.765",
             "70", "480", "550", "540", "89", "65", "231", "119", "1797", "2000", "2.34", "0.39"]
    return (pid, rank, name, "LAL", *stats, "1610612747")


LEADER_ROWS = [
    leader_row("201", "1", "LeBron James"),
    leader_row("202", "2", "Victor Wembanyama"),
    leader_row("202", "3", "Victor W. (duplicate)"),
    leader_row(None, "4", "No Id"),
    leader_row("999", "5", "Not In Information"),
]

BOX_HEADER = (
    "SEASON_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_NAME", "GAME_ID", "GAME_DATE", "MIN", "FGM",
    "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB",
    "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS", "FANTASY_PTS", "VIDEO_AVAILABLE",
)


def box_row(pid, game, date):
    stats = ["35.0", "10", "20", "0.5", "2", "5", "0.4", "3", "4", "0.75", "1", "7", "8",
             "9", "1", "0", "3", "2", "25", "-7", "48.3"]
    return ("22023", pid, "Name", "Team", game, date, *stats, "1")


BOX_ROWS = [
    box_row("201", "0022300001", "2023-10-24"),
    box_row("201", "0022300002", "2023-10-26"),
    box_row("202", "0022300003", "2023-1-4"),
    box_row("203", "0022300004", "2023-10-24"),
    box_row(None, "0022300005", "2023-13-45"),
]

TEAM_LEADER_STATS = (
    "GP", "W", "L", "W_PCT", "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM",
    "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST", "TOV", "STL", "BLK", "BLKA", "PF", "PFD",
    "PTS", "PLUS_MINUS",
)
TEAM_LEADER_HEADER = ("TEAM_ID", "TEAM_NAME") + TEAM_LEADER_STATS + TEAM_LEADER_DROP
TEAM_LEADER_ROWS = [
    ("1610612738", "Boston Celtics", "82", "64", "18", "0.78", "19805.0", "3601", "7396",
     "0.487", "1351", "3482", "0.388", "1418", "1757", "0.807", "906", "2864", "3770", "2207",
     "975", "552", "540", "356", "1318", "1457", "9971", "939", *[str(i) for i in range(1, 27)]),
]

TEAM_BOX_HEADER = (
    "SEASON_ID", "TEAM_ID", "TEAM_NAME", "GAME_ID", "GAME_DATE", "MIN", "FGM", "FGA",
    "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST",
    "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS", "VIDEO_AVAILABLE",
)
TEAM_BOX_ROWS = [
    ("22023", "1610612738", "Boston Celtics", "0022300001", "2023-10-24", "240", "48", "95",
     "0.505", "20", "45", "0.444", "12", "14", "0.857", "10", "38", "48", "26", "6", "5", "11",
     "15", "128", "24.0", "1"),
]


def frame(spark, header, rows):
    schema = ", ".join(f"`{h}` string" for h in header)
    return spark.createDataFrame(rows, schema)

"""The whole daily flow as the original DAG runs it: captured API responses
and stored profile pages are landed as the five CSVs (G7, G8), then typed and
related into the five tables (G1-G5)."""

import json
import os

from pyspark.sql import functions as F

from statflow.plans import stat_tables as T
from statflow.sources import read_pages, write_csv, write_parquet
from tests import fixtures as X

# Stats are read from the odd-numbered stat blocks and info from the
# even-numbered info blocks (0-based), as on the profile pages; the other
# blocks are layout.
PAGE_TEMPLATE = """<html><body>
<div class="stat">SEASON</div><div class="stat">PPG<br>{ppg}</div>
<div class="stat">-</div><div class="stat">RPG<br>{rpg}</div>
<div class="stat">-</div><div class="stat">APG<br>{apg}</div>
<div class="stat">-</div><div class="stat">PIE<br>{pie}</div>
<div class="info top">HEIGHT<br>{height}</div><div class="info top">|</div>
<div class="info top">WEIGHT<br>{weight}</div><div class="info top">|</div>
<div class="info top">COUNTRY<br>{country}</div><div class="info top">|</div>
<div class="info top">LAST ATTENDED<br>{school}</div>
<div class="info bottom">AGE<br>{age}</div><div class="info bottom">|</div>
<div class="info bottom">BIRTHDATE<br>{born}</div><div class="info bottom">|</div>
<div class="info bottom">DRAFT<br>{draft}</div><div class="info bottom">|</div>
<div class="info bottom">EXPERIENCE<br>{exp}</div>
<p class="position">{position}</p></body></html>"""


def _envelope(header, rows, form):
    rs = {"headers": list(header), "rowSet": [list(r) for r in rows]}
    return json.dumps({"resultSet": rs} if form == 1 else {"resultSets": [rs]})


def test_captures_to_five_tables(spark, tmp_dir):
    raw, landing, out = (os.path.join(tmp_dir, d) for d in ("raw", "landing", "tables"))
    captures = {
        "player_leader": (X.LEADER_HEADER, X.LEADER_ROWS, 1),
        "team_leader": (X.TEAM_LEADER_HEADER, X.TEAM_LEADER_ROWS, 2),
        "player_box": (X.BOX_HEADER, X.BOX_ROWS, 2),
        "team_box": (X.TEAM_BOX_HEADER, X.TEAM_BOX_ROWS, 2),
    }
    for key, (header, rows, form) in captures.items():
        os.makedirs(f"{raw}/{key}")
        with open(f"{raw}/{key}/response.json", "w") as f:
            f.write(_envelope(header, rows, form))
        landed, _ = T.land_payloads(spark, f"{raw}/{key}", list(header))
        write_csv(landed, f"{landing}/{T.SOURCES[key]}.csv")
    os.makedirs(f"{raw}/pages")
    players = {"201": dict(ppg="25.1", rpg="7.3", apg="8.1", pie="0.19",
                           height="6'9\" (2.06m)", weight="250lb (113kg)", country="USA",
                           school="St. Vincent", age="39 years", born="December 30, 1984",
                           draft="2003 R1 Pick 1", exp="20 Years",
                           position="Lakers | #23 | Forward"),
               "202": dict(ppg="--", rpg="10.6", apg="3.9", pie="0.16", height="7'4\" (2.24m)",
                           weight="210lb (95kg)", country="FRA", school="France",
                           age="20 years", born="January 4, 2004", draft="2023 R1 Pick 1",
                           exp="Rookie", position="Spurs | #1 | Center")}
    for pid, fields in players.items():
        with open(f"{raw}/pages/{pid}.html", "w") as f:
            f.write(PAGE_TEMPLATE.format(**fields))
    pages = read_pages(spark, f"{raw}/pages").withColumn(
        "PLAYER_ID", F.regexp_extract("source", r"(\d+)\.html$", 1))
    info, bad = T.land_pages(pages)
    assert bad.count() == 0
    write_csv(info, f"{landing}/{T.SOURCES['player_information']}.csv")

    T.run_daily(spark, landing, lambda df, name: write_parquet(df, f"{out}/{name}"))

    t1 = {r.PLAYER_ID: r for r in spark.read.parquet(f"{out}/nba_player_information").collect()}
    assert sorted(t1) == ["201", "202"]
    assert t1["201"].COUNTRY == "United States" and t1["201"]["HEIGHT(m)"] > 2.05
    assert t1["201"].PLAYER_NAME == "LeBron James" and str(t1["201"].BIRTHDATE) == "1984-12-30"
    assert t1["202"].PPG == 0.0 and t1["202"].EXPERIENCE == 0.0 and t1["202"].POSITION == " Center"
    t2 = spark.read.parquet(f"{out}/nba_player_box_scores_rs")
    assert sorted(r.GAME_ID for r in t2.collect()) == ["0022300001", "0022300002", "0022300003"]
    t4 = spark.read.parquet(f"{out}/nba_team_leader").first()
    assert t4.MIN == 19805 and t4.W_PCT > 0.77
    assert spark.read.parquet(f"{out}/nba_team_box_scores_rs").first().PTS == 128
    assert dict(spark.read.parquet(f"{out}/nba_player_leader").dtypes)["GP"] == "string"

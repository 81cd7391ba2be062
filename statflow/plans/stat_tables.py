"""The five statistics tables (G1-G5), payload/page landings (G7, G8) and
the daily load that writes all five.

The table functions are lazy; :func:`run_daily` and the landings, which split
one parse into rows and quarantine, run jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.operators.changes import snapshot_changes
from statflow.operators.htmlblocks import extract_page_row_parsed
from statflow.operators.htmlpaths import extract_page_row_paths
from statflow.operators.profile import (
    apply_profile,
    check_columns,
    check_contract,
    profile_contract,
)
from statflow.operators.relate import inner_join, semi_reduce
from statflow.operators.unpack import (
    extract_page_row,
    html_lines,
    name_positional,
    page_row_is_bad,
    split_flagged,
    split_malformed,
    unpack_rowset_flagged,
)
from statflow.plans.profiles import (
    LEADER_NAME_COLUMN,
    PLAYER_BOX_PROFILE,
    PLAYER_INFORMATION_HEADER,
    PLAYER_KEY,
    PLAYER_LEADER_PROFILE,
    PLAYER_NAME_COLUMN,
    TEAM_BOX_PROFILE,
    TEAM_LEADER_PROFILE,
    player_information_profile,
)
from statflow.session import ensure_checkpoint_dir
from statflow.sources.captures import RANGE_BYTES, read_capture_rows
from statflow.sources.csv import read_string_csv, table_path
from statflow.sources.files import read_payloads
from statflow.sources.headers import read_any_csv
from statflow.sources.versions import Publication, manifest, read_tables

# Landing file names and output table names.
SOURCES = {
    "player_leader": "nba_player_leader",
    "team_leader": "nba_team_leader",
    "player_information": "nba_player_information",
    "player_box": "player_box_scores_rs",
    "team_box": "team_box_scores_rs",
}
TABLES = {
    "player_information": "nba_player_information",
    "player_box": "nba_player_box_scores_rs",
    "player_leader": "nba_player_leader",
    "team_leader": "nba_team_leader",
    "team_box": "nba_team_box_scores_rs",
}


def player_information(
    info_raw: DataFrame,
    leader_raw: DataFrame,
    country_codes: dict[str, str] | None = None,
    fill_missing: bool = True,
    salt: int | str = 1,
) -> DataFrame:
    """G1: typed player profiles joined (inner, by PLAYER_ID) with the
    leader board's player name, which becomes PLAYER_NAME. Players without
    a leader row drop; duplicate leader keys fan out. ``salt`` splits heavy
    PLAYER_IDs (see :func:`statflow.operators.relate.inner_join`)."""
    typed = apply_profile(info_raw, player_information_profile(country_codes, fill_missing))
    names = leader_raw.select(PLAYER_KEY, LEADER_NAME_COLUMN)
    joined = inner_join(typed, names, PLAYER_KEY, salt=salt)
    return joined.withColumnRenamed(LEADER_NAME_COLUMN, PLAYER_NAME_COLUMN)


def player_box_scores(
    box_raw: DataFrame, information: DataFrame, salt: int | str = 1
) -> DataFrame:
    """G2: box scores of players that survived G1 (left-semi join on the
    joined table's keys), typed."""
    kept = semi_reduce(box_raw, information, PLAYER_KEY, salt=salt)
    return apply_profile(kept, PLAYER_BOX_PROFILE)


def player_leader(leader_raw: DataFrame) -> DataFrame:
    """G3: leader board typed; GP stays a string as in the source job."""
    return apply_profile(leader_raw, PLAYER_LEADER_PROFILE)


def team_leader(raw: DataFrame) -> DataFrame:
    """G4: team leader board typed, the ``*_RANK`` twins dropped."""
    return apply_profile(raw, TEAM_LEADER_PROFILE)


def team_box_scores(raw: DataFrame) -> DataFrame:
    """G5: team game log typed."""
    return apply_profile(raw, TEAM_BOX_PROFILE)


# Typed output columns of each table (checked before every write).
CONTRACTS = {
    "player_information": {
        **profile_contract(player_information_profile()), PLAYER_NAME_COLUMN: "string"},
    "player_box": profile_contract(PLAYER_BOX_PROFILE),
    "player_leader": {**profile_contract(PLAYER_LEADER_PROFILE), "GP": "string"},
    "team_leader": profile_contract(TEAM_LEADER_PROFILE),
    "team_box": profile_contract(TEAM_BOX_PROFILE),
}
DROPPED = {
    "player_information": ("HEIGHT", "WEIGHT", "LAST ATTENDED", LEADER_NAME_COLUMN),
    "player_box": PLAYER_BOX_PROFILE.drop,
    "player_leader": PLAYER_LEADER_PROFILE.drop,
    "team_leader": TEAM_LEADER_PROFILE.drop,
    "team_box": TEAM_BOX_PROFILE.drop,
}


def read_sources(spark: SparkSession, base: str, by_name: bool = False) -> dict[str, DataFrame]:
    """The five CSV landings under ``base`` (any Hadoop URI), as strings.
    ``by_name``: a landing's files may have their columns in different orders,
    or more or fewer of them (:mod:`statflow.sources.headers`)."""
    read = read_any_csv if by_name else read_string_csv
    return {k: read(spark, table_path(base, v)) for k, v in SOURCES.items()}


def build_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    info = player_information(raw["player_information"], raw["player_leader"])
    return {
        "player_information": info,
        "player_box": player_box_scores(raw["player_box"], info),
        "player_leader": player_leader(raw["player_leader"]),
        "team_leader": team_leader(raw["team_leader"]),
        "team_box": team_box_scores(raw["team_box"]),
    }


def run_daily(
    spark: SparkSession,
    base: str,
    write: Callable[[DataFrame, str], None],
    salt: int | str = "auto",
    concurrent_writes: int = 1,
    by_name: bool = False,
) -> dict[str, DataFrame]:
    """Read the five landings, type them and hand each table to ``write``
    (e.g. a JDBC or Parquet overwrite).

    G1 is checkpointed to the shared ``spark.checkpoint.dir`` first: the
    G1 write and G2's semi-join both read that copy, so the leader and
    information scans run once and a lost executor recomputes from the
    checkpoint, not from the raw landings. ``salt`` is passed to the G1
    join and the G2 semi-join (``"auto"`` splits heavy PLAYER_IDs only).
    ``by_name`` binds the columns of every landing file by name.
    With ``concurrent_writes > 1`` the four tables after G1 are written by
    that many concurrent Spark jobs, so small tables do not wait for the
    large box scores while the cluster has free cores.
    """
    ensure_checkpoint_dir(spark)
    raw = read_sources(spark, base, by_name)
    info = player_information(
        raw["player_information"], raw["player_leader"], salt=salt
    ).checkpoint(eager=True)
    tables = {
        "player_information": info,
        "player_box": player_box_scores(raw["player_box"], info, salt=salt),
        "player_leader": player_leader(raw["player_leader"]),
        "team_leader": team_leader(raw["team_leader"]),
        "team_box": team_box_scores(raw["team_box"]),
    }
    for key, df in tables.items():
        check_contract(df, CONTRACTS[key], DROPPED[key])
    write(info, TABLES["player_information"])
    rest = [k for k in tables if k != "player_information"]
    if concurrent_writes <= 1:
        for key in rest:
            write(tables[key], TABLES[key])
    else:
        with ThreadPoolExecutor(max_workers=concurrent_writes) as pool:
            done = [pool.submit(write, tables[k], TABLES[k]) for k in rest]
            for f in done:
                f.result()  # re-raise the first failure
    return tables


#: What tells rows of a table apart (rows of equal keys are compared as a bag).
KEYS = {
    "player_information": ["PLAYER_ID"],
    "player_box": ["PLAYER_ID", "GAME_ID"],
    "player_leader": ["PLAYER_ID"],
    "team_leader": ["TEAM_ID"],
    "team_box": ["TEAM_ID", "GAME_ID"],
}


def run_daily_published(spark: SparkSession, base: str, out: str, salt: int | str = "auto",
                        concurrent_writes: int = 1, by_name: bool = False) -> int:
    """The daily load with all five tables shown at once: they are written to
    new folders below ``out``, and one manifest swaps them in at the end
    (:mod:`statflow.sources.versions`). A failure before leaves all five old
    tables. Returns the manifest's number."""
    publication = Publication(spark, out)
    run_daily(spark, base, publication.write, salt, concurrent_writes, by_name)
    return publication.commit()


def daily_changes(spark: SparkSession, out: str, before: int | None = None, after: int | None = None
                  ) -> dict[str, DataFrame]:
    """For each of the five tables the rows that changed from publication
    ``before`` (default: the one before the newest) to ``after`` (the newest),
    for a sink that takes upserts: ``write_table_once(..., mode="changes",
    key=KEYS[table])``."""
    newest = manifest(spark, out, after)
    if newest is None:
        raise FileNotFoundError(f"nothing published in {out}")
    new = read_tables(spark, out, newest["number"])
    old = read_tables(spark, out, newest["number"] - 1 if before is None else before)
    return {key: snapshot_changes(old[TABLES[key]], new[TABLES[key]], KEYS[key]) for key in TABLES}


def land_payloads_flagged(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, one_per_line: bool = False
) -> DataFrame:
    """G7: captured API responses -> string rows and what could not be landed,
    with ``status`` and ``source`` file. ``one_per_line`` reads JSON Lines."""
    return unpack_rowset_flagged(read_payloads(spark, path, one_per_line), "payload", columns,
                                 keep=["source"])


def land_payloads(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, one_per_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """G7 as (string table, quarantine) from one parse: the flagged rows are
    checkpointed in the shared folder, and both tables read that copy."""
    ensure_checkpoint_dir(spark)
    flagged = land_payloads_flagged(spark, path, columns, one_per_line).checkpoint()
    good, bad = split_flagged(flagged, ["source"])
    return good.drop("source"), bad


def land_captures(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """G7 for captures of any size: the rows of a file are read by as many
    tasks as it has byte ranges. Same (string table, quarantine) as
    :func:`land_payloads`, but that an unreadable capture is kept by its path
    alone."""
    flagged = read_capture_rows(spark, path, columns, range_bytes).withColumn(
        "payload", F.lit(None).cast("string")).checkpoint()
    good, bad = split_flagged(flagged, ["source"])
    return good.drop("source"), bad


# Where the profile page keeps its blocks (stats, the two info
# groups, position) when stored as HTML.
PAGE_STAT_BLOCKS = r'(?s)<div class="stat">(.*?)</div>'
PAGE_INFO_BLOCKS = (r'(?s)<div class="info top">(.*?)</div>', r'(?s)<div class="info bottom">(.*?)</div>')
PAGE_POSITION = r'(?s)<p class="position">(.*?)</p>'


def land_pages(
    pages: DataFrame,
    key: str = "PLAYER_ID",
    html: str = "html",
    stat_pattern: str = PAGE_STAT_BLOCKS,
    info_pattern: str | Sequence[str] = PAGE_INFO_BLOCKS,
    position_pattern: str = PAGE_POSITION,
    header: Sequence[str] = PLAYER_INFORMATION_HEADER,
) -> tuple[DataFrame, DataFrame]:
    """G8: stored profile pages -> (rows named by ``header``, quarantine).
    A pattern that starts with ``/`` is a path in the element tree; then all
    are (:func:`land_pages_by_path`).

    A block's text is taken as rendered lines (label on the first line, the
    value on the second, whether split by ``<br>`` or by nested elements);
    a page whose blocks lack the value line or which has more values than
    the header goes to quarantine instead of being silently skipped. The
    block patterns match the page template; a block with a nested element
    of its own closing tag needs a pattern that spans it."""
    if stat_pattern.startswith("/"):
        return land_pages_by_path(pages, key, html, stat_pattern, info_pattern, position_pattern, header)
    check_columns(pages, [key, html])
    rows = extract_page_row(pages, html, key, stat_pattern, info_pattern, position_pattern,
                            text=html_lines)
    return _name_or_quarantine(rows, header)


# Where the source's profile page keeps its blocks (stats, the
# two info groups, position).
PAGE_STAT_PATH = "/html/body/div[1]/div[2]/div[2]/section/div[1]/section[2]/div/div[1]/div"
PAGE_INFO_PATHS = (
    "/html/body/div[1]/div[2]/div[2]/section/div[1]/section[2]/div/div[2]/div[2]/div",
    "/html/body/div[1]/div[2]/div[2]/section/div[1]/section[2]/div/div[2]/div[4]/div",
)
PAGE_POSITION_PATH = "/html/body/div[1]/div[2]/div[2]/section/div[1]/section[1]/div[2]/div/div[2]/div[1]/p[1]"


def land_pages_by_path(
    pages: DataFrame,
    key: str = "PLAYER_ID",
    html: str = "html",
    stat_path: str = PAGE_STAT_PATH,
    info_path: str | Sequence[str] = PAGE_INFO_PATHS,
    position_path: str = PAGE_POSITION_PATH,
    header: Sequence[str] = PLAYER_INFORMATION_HEADER,
) -> tuple[DataFrame, DataFrame]:
    """G8 for pages stored as the source serves them: blocks addressed by
    their places in the element tree, no class names needed; same rows and
    quarantine rules as :func:`land_pages`."""
    check_columns(pages, [key, html])
    rows = extract_page_row_paths(pages, html, key, stat_path, info_path, position_path)
    return _name_or_quarantine(rows, header)


# The CSS classes of the profile page's blocks.
PAGE_STAT_CLASS, PAGE_POSITION_CLASS = "stat", "position"
PAGE_INFO_CLASSES = ("top", "bottom")


def land_pages_parsed(
    pages: DataFrame,
    key: str = "PLAYER_ID",
    html: str = "html",
    stat_class: str = PAGE_STAT_CLASS,
    info_class: str | Sequence[str] = PAGE_INFO_CLASSES,
    position_class: str = PAGE_POSITION_CLASS,
    header: Sequence[str] = PLAYER_INFORMATION_HEADER,
) -> tuple[DataFrame, DataFrame]:
    """G8 through the HTML-parser route (blocks by CSS class, nesting-safe);
    same rows and quarantine rules as :func:`land_pages`."""
    check_columns(pages, [key, html])
    rows = extract_page_row_parsed(pages, html, key, stat_class, info_class, position_class)
    return _name_or_quarantine(rows, header)


def _name_or_quarantine(rows: DataFrame, header: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows named by ``header``, quarantine), both from one checkpoint."""
    ensure_checkpoint_dir(rows.sparkSession)
    good, bad = split_malformed(rows.checkpoint(), page_row_is_bad("values", len(header)))
    return name_positional(good, "values", header), bad

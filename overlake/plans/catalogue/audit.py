"""Reconciliation with published figures, and the standard data checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from overlake.functions import count_when
from overlake.operators import quality
from overlake.operators.reconcile import reconcile
from overlake.plans.catalogue._shared import LEAGUE, down, league_innings, up
from overlake.plans.catalogue.team import batting_summary, bowling_summary
from overlake.plans.rules import REQUIRED, RUNS_DO_NOT_ADD_UP, WINNER_DID_NOT_PLAY, row_conditions
from overlake.schemas import struct
from overlake.sources.seeds import seed_frame

# Published league careers (player, runs, hundreds, fifties, note).
PUBLISHED_BATTING = [
    ("DA Warner", 6565, 4, 62, "retired"),
    ("SK Raina", 5528, 1, 39, "retired"),
    ("AB de Villiers", 5162, 3, 40, "retired"),
    ("CH Gayle", 4965, 6, 31, "retired"),
    ("V Kohli", 8908, 8, 65, "active, may lag"),
    ("RG Sharma", 7183, 2, 48, "active, may lag"),
    ("MS Dhoni", 5439, 0, 24, "active"),
    ("KL Rahul", 5427, 5, 42, "active, may lag"),
    ("SL Malinga", None, None, None, "no batting figures"),
    ("JJ Bumrah", None, None, None, "no batting figures"),
]
# Published league careers (player, wickets, note).
PUBLISHED_BOWLING = [
    ("SL Malinga", 170, "retired"),
    ("JJ Bumrah", 183, "active, may lag"),
]
PLAYERS = [row[0] for row in PUBLISHED_BATTING]

_S, _L = T.StringType(), T.LongType()
BATTING_EXPECTED = T.StructType(
    [T.StructField(n, _S if n in ("player", "note") else _L) for n in ("player", "runs", "100", "50", "note")]
)
BOWLING_EXPECTED = struct(player=_S, wkts=_L, note=_S)


def career_batting(t, players: Sequence[str] = PLAYERS, league: str = LEAGUE) -> DataFrame:
    rows = league_innings(t, t.batting, league).filter(F.col("player_name").isin(*players))
    ducks = count_when("runs = 0 AND NOT not_out").alias("ducks")
    figures = rows.groupBy(F.col("player_name").alias("player")).agg(*batting_summary(), ducks)
    return figures.selectExpr(
        "player", "mat", "inns", "no", "runs", "hs", "avg", "bf", "sr",
        "`100s` AS `100`", "`50s` AS `50`", "ducks", "`4s`", "`6s`",
    ).orderBy(down("runs"), up("player"))


def career_bowling(t, players: Sequence[str] = PLAYERS, league: str = LEAGUE) -> DataFrame:
    rows = league_innings(t, t.bowling, league).filter(F.col("player_name").isin(*players))
    per_player = rows.groupBy(F.col("player_name").alias("player"))
    return per_player.agg(*bowling_summary("4w", "5w")).orderBy(down("wkts"), up("player"))


def reconcile_batting(t, expected: Sequence[tuple] = PUBLISHED_BATTING, league: str = LEAGUE) -> DataFrame:
    spark = t.batting.sparkSession
    published = seed_frame(spark, expected, BATTING_EXPECTED)
    actual = career_batting(t, [row[0] for row in expected], league)
    return reconcile(actual, published, "player", ["runs", "100", "50"])


def reconcile_bowling(t, expected: Sequence[tuple] = PUBLISHED_BOWLING, league: str = LEAGUE) -> DataFrame:
    spark = t.bowling.sparkSession
    published = seed_frame(spark, expected, BOWLING_EXPECTED)
    actual = career_bowling(t, [row[0] for row in expected], league)
    return reconcile(actual, published, "player", ["wkts"])


# data checks -----------------------------------------------------------------

UNIQUE = {
    "stg_matches": "match_id",
    "match_results": "match_id",
    "dim_players": "player_name",
    "batting_career": ("player_name", "match_type"),
    "bowling_career": ("player_name", "match_type"),
}
CHILDREN = ("stg_innings", "stg_deliveries", "stg_players")


# As the condition that breaks it; it needs the innings' match.
BATTING_SIDE_DID_NOT_PLAY = "batting_team <> team_1 AND batting_team <> team_2"


def runs_add_up(t) -> DataFrame:
    """Balls whose total is not runs off the bat plus extras."""
    return t.balls.filter(RUNS_DO_NOT_ADD_UP).select(
        "match_id", "innings_number", "over_number", "ball_in_over",
        "runs_batter", "runs_extras", "runs_total",
    )


def winner_took_part(t) -> DataFrame:
    """Matches won by a team that did not play in them."""
    return t.match_results.filter(WINNER_DID_NOT_PLAY).select(
        "match_id", "team_1", "team_2", "outcome_winner"
    )


def batting_team_took_part(t) -> DataFrame:
    """Innings whose batting side is neither of the match's teams."""
    sides = t.stg_matches.select("match_id", "team_1", "team_2")
    return t.stg_innings.join(sides, "match_id").filter(BATTING_SIDE_DID_NOT_PLAY).select(
        "match_id", "innings_number", "batting_team", "team_1", "team_2"
    )


def check_report(t) -> DataFrame:
    """One row (check, table, column, failures) per standard check.

    Rows of stored tables were counted as they were written, so rules on one row alone cost no
    scan; where that is not known all conditions on a table are counted in one pass over it.
    Child tables are joined to their matches, and keys grouped, in either case.
    """
    conditions = {table: row_conditions(table) for table in REQUIRED}
    known = {
        table: {name: n for name, n in t.broken_rows(table).items() if name in found}
        for table, found in conditions.items()
        if hasattr(t, "broken_rows")
    }
    for child in CHILDREN:
        conditions[child]["relationships|match_id"] = "match_id IS NOT NULL AND parent IS NULL"
    conditions["stg_innings"]["rule|batting_team"] = BATTING_SIDE_DID_NOT_PLAY
    # One row per match, also where matches repeat, so that no child is counted twice.
    teams = F.min(F.struct("team_1", "team_2")).alias("teams")
    parents = t.stg_matches.groupBy("match_id").agg(teams).selectExpr("match_id", "teams.*", "true AS parent")

    def labelled(counts: DataFrame, table: str) -> DataFrame:
        return counts.selectExpr(
            "substring_index(name, '|', 1) AS check", f"'{table}' AS table",
            "substring(name, instr(name, '|') + 1) AS column", "failures",
        )

    rows: list[DataFrame] = []
    for table, found in conditions.items():
        left = {name: cond for name, cond in found.items() if name not in known.get(table, {})}
        if not left:
            continue
        df = getattr(t, table)
        if table in CHILDREN:
            df = df.join(parents, "match_id", "left")
        rows.append(labelled(quality.violation_counts(df, left), table))
    for table, key in UNIQUE.items():
        name = key if isinstance(key, str) else "|".join(key)
        value = F.col(key) if isinstance(key, str) else F.concat_ws("|", *key)
        repeated = quality.unique(getattr(t, table), value).agg(F.count("*").alias("failures"))
        rows.append(labelled(repeated.withColumn("name", F.lit(f"unique|{name}")), table))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    counted = [(*name.split("|", 1), table, n) for table, found in known.items() for name, n in found.items()]
    if counted:
        spark = t.stg_matches.sparkSession
        # One row per rule.
        metrics = spark.createDataFrame(counted, "check string, column string, table string, failures long")
        out = out.unionByName(metrics)
    return out

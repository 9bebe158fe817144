"""Figures per over and bowler, and batting and bowling figures per innings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import (
    BOWLER_RUNS,
    CREDITED_WICKET,
    DOT_BALL,
    FOUR,
    LEGAL_BALL,
    PHASES,
    SIX,
    TEAM_WICKET,
    WIDE_FREE,
    count_when,
    named,
    overs_decimal,
    ratio,
    ratio_sql,
)
from overlake.schemas import BATTING_INNINGS, BOWLING_INNINGS

_MATCH = ["match_id", "match_type", "year", "match_date", "season", "innings_number"]
_SIDES = ["batting_team", "bowling_team"]
# Constant within an innings, carried for the queries.
_CARRIED = ["super_over", "event_name"]

NOT_A_DISMISSAL = "retired hurt"

# Additive figures of an over.  Where a query sums balls over anything no finer than
# over and bowler, it sums these instead and reads a sixth of the rows.
_COUNTED = {
    "legal": LEGAL_BALL,
    "non_wides": WIDE_FREE,
    "credited": CREDITED_WICKET,
    "team_wkts": TEAM_WICKET,
    "dots": DOT_BALL,
    "fours": FOUR,
    "sixes": SIX,
    "wides": "extras_wides > 0",
    "no_balls": "extras_noballs > 0",
}
_SUMMED = {
    "bat_runs": "runs_batter",
    "runs": "runs_total",
    "charged_runs": BOWLER_RUNS,
    "wkts": "wicket_count",
    "wide_runs": "extras_wides",
    "no_ball_runs": "extras_noballs",
}


def over_figures(balls: DataFrame) -> DataFrame:
    """One row per over and bowler: the additive figures of its balls.

    All measures are numbers, so both halves of the aggregate are hash based, and the
    balls of an over meet before the exchange.
    """
    keys = [*_MATCH, "over_number", *_SIDES, *_CARRIED, "balls_per_over"]
    return balls.groupBy(*keys, F.col("bowler").alias("player_name")).agg(
        *named(deliveries="count(*)"),
        *[count_when(cond).alias(name) for name, cond in _COUNTED.items()],
        *named(**{name: f"sum({value})" for name, value in _SUMMED.items()}),
    )


def wickets(balls: DataFrame) -> DataFrame:
    """Balls with a wicket: about one in twenty, for queries on how players get out."""
    return balls.filter("is_wicket").select(
        *_MATCH, "over_number", "ball_in_over", *_SIDES, *_CARRIED, "bowler", "wicket_kind",
        "wicket_player_out", "wicket_fielders", "wicket_fielders_arr",
    )


def powerplay_batters(balls: DataFrame) -> DataFrame:
    """One row per innings and batter who faced a ball in the powerplay."""
    first, last, _ = PHASES["pp"]
    facing = balls.filter(F.col("over_number").between(first, last))
    return facing.select(*_MATCH, *_SIDES, *_CARRIED, F.col("batter").alias("player_name")).distinct()


def bowling_innings(overs: DataFrame) -> DataFrame:
    """One row per bowler and innings.

    Beyond the contract it carries the maidens and the runs charged to the bowler.  An
    over is a maiden when nothing was charged in at least six deliveries of it.
    """
    keys = [*_MATCH, *_SIDES, *_CARRIED, "balls_per_over", "player_name"]
    figures = overs.groupBy(*keys).agg(
        *named(
            legal_deliveries="sum(legal)",
            total_deliveries="sum(deliveries)",
            runs_conceded="sum(runs)",
            wickets="sum(wkts)",
            wickets_credited="sum(credited)",
            no_balls="sum(no_balls)",
            wides="sum(wides)",
            charged_runs="sum(charged_runs)",
        ),
        count_when("charged_runs = 0 AND deliveries >= 6").alias("maidens"),
    )
    economy = ratio("cast(runs_conceded AS double) * cast(balls_per_over AS double)", "legal_deliveries")
    return figures.withColumns(
        {
            "overs_bowled": overs_decimal("legal_deliveries", "balls_per_over"),
            "economy": economy,
            "first_of_match": F.expr(_first_of_match("NOT super_over")),
        }
    ).select(*BOWLING_INNINGS, "event_name", "charged_runs", "maidens", "first_of_match")


def _first_of_match(counts: str) -> str:
    """Whether an innings is the first that counts of its player in the match."""
    earlier = f"PARTITION BY match_id, player_name ORDER BY if({counts}, 0, 1), innings_number, batting_team, bowling_team"
    return f"({counts}) AND row_number() OVER ({earlier}) = 1"


def _role(name: str, player: str, kind: str = "NULL") -> str:
    """One player's part in a ball; only the batter brings figures."""

    def figure(value: str) -> str:
        return value if name == "bat" else "0"

    return f"""named_struct(
        'player_name', {player}, 'role', '{name}', 'faced', {figure("1")},
        'runs', {"runs_batter" if name == "bat" else "cast(NULL AS int)"},
        'wide', {figure("CASE WHEN extras_wides > 0 THEN 1 ELSE 0 END")},
        'non_wide', {figure(f"CASE WHEN {WIDE_FREE} THEN 1 ELSE 0 END")},
        'four', {figure(f"CASE WHEN {FOUR} THEN 1 ELSE 0 END")},
        'six', {figure(f"CASE WHEN {SIX} THEN 1 ELSE 0 END")},
        'kind', cast({kind} AS string))"""


def _roles() -> Column:
    kind = f"CASE WHEN wicket_kind <> '{NOT_A_DISMISSAL}' THEN wicket_kind END"
    out = f"CASE WHEN is_wicket AND wicket_player_out IS NOT NULL THEN {_role('out', 'wicket_player_out', kind)} END"
    return F.expr(f"inline(array({_role('bat', 'batter')}, {_role('stood', 'non_striker')}, {out}))")


def participation(balls: DataFrame) -> DataFrame:
    """One row per player and innings in which the player faced, stood at the other end
    or was out, with the batting figures.

    ``counted`` marks the rows that are batting innings: the player faced a ball; or
    was dismissed, perhaps without facing one; or stood at the other end without facing
    or being out, unless the player bats elsewhere in the same match (``batted``), which
    points to a wrong name in the record.  ``out_any`` also tells of being retired hurt,
    which is no dismissal.

    Every ball gives one row per role a player has in it; one partially aggregated
    exchange by innings and player replaces separate plans for the three cases.
    """
    keys = [*_MATCH, *_SIDES, *_CARRIED]
    exploded = (
        balls.select(*keys, _roles())
        .filter("role IS NOT NULL")
        # Rows without a name never match each other, so roles stay apart for them.
        .withColumn("unnamed_role", F.expr("CASE WHEN player_name IS NULL THEN role END"))
    )
    # The kind is part of the first grouping instead of a string maximum: this keeps
    # the pass over all balls a hash aggregation.
    by_kind = exploded.groupBy(*keys, "player_name", "unnamed_role", "kind").agg(
        *named(
            faced="sum(faced)",
            runs="sum(runs)",
            wides_faced="sum(wide)",
            non_wides="sum(non_wide)",
            fours="sum(four)",
            sixes="sum(six)",
            stood="max(if(role = 'stood', 1, 0))",
            out="max(if(role = 'out', 1, 0))",
            dismissed="max(if(kind IS NOT NULL, 1, 0))",
        )
    )
    # Placed by match and player once, which serves the second grouping and the window.
    placed = by_kind.repartition("match_id", "player_name")
    per_player = placed.groupBy(*keys, "player_name", "unnamed_role").agg(
        *named(
            balls_faced="sum(faced)",
            runs="sum(runs)",
            wides_faced="sum(wides_faced)",
            non_wides="sum(non_wides)",
            fours="sum(fours)",
            sixes="sum(sixes)",
            stood="max(stood)",
            out="max(out)",
            dismissals="max(dismissed)",
            dismissal_kind="max(kind)",
        )
    )
    batted = "max(balls_faced > 0) OVER (PARTITION BY match_id, player_name) AND player_name IS NOT NULL"
    strike_rate = ratio_sql("runs", "(balls_faced - wides_faced)", 2, times=100)
    return (
        per_player.withColumn("batted", F.expr(batted))
        .select(
            *[c for c in BATTING_INNINGS if c not in ("runs", "strike_rate", "not_out")],
            "event_name",
            "non_wides",
            "batted",
            *named(
                runs="coalesce(runs, CASE WHEN balls_faced = 0 THEN 0 END)",
                strike_rate=f"CASE WHEN balls_faced > 0 THEN {strike_rate} END",
                not_out="dismissals = 0",
                out_any="out > 0",
                counted="balls_faced > 0 OR dismissals > 0 OR (stood > 0 AND NOT batted)",
            ),
        )
        # The rows are placed by match and player already, so this window moves nothing.
        .withColumn("first_of_match", F.expr(_first_of_match("counted AND NOT super_over")))
        .select(*BATTING_INNINGS, "event_name", "non_wides", "out_any", "batted", "counted", "first_of_match")
    )


def batting_innings(took_part: DataFrame) -> DataFrame:
    return took_part.filter("counted")


def dismissals(took_part: DataFrame) -> DataFrame:
    """Dismissed players per innings, whoever faced the ball, with the kind."""
    out = took_part.filter("dismissals > 0 AND player_name IS NOT NULL")
    return out.select("match_id", "innings_number", "player_name", "dismissal_kind")


def match_batters(took_part: DataFrame) -> DataFrame:
    """Distinct (match, player) of everybody who faced a ball in the match."""
    return took_part.filter("balls_faced > 0").select("match_id", "player_name").distinct()


def zero_ball_dismissals(took_part: DataFrame) -> DataFrame:
    """Batting innings that ended without a ball faced."""
    return took_part.filter("balls_faced = 0 AND dismissals > 0")


def non_striker_only(took_part: DataFrame) -> DataFrame:
    """Batting innings spent at the other end only."""
    return took_part.filter("counted AND balls_faced = 0 AND dismissals = 0")

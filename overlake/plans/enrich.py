"""Match context for balls, and match results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from overlake.operators.names import canonicalize
from overlake.schemas import BALL_BY_BALL, MATCH_RESULTS

# Carried by the ball table beyond its contract: what nearly every query would
# otherwise have to join back in.
BALL_EXTRAS = ["super_over", "event_name", "wicket_fielders_arr"]


def _canonical_matches(matches: DataFrame, team_map: DataFrame, venue_map: DataFrame) -> DataFrame:
    """Matches with ``team_1_c``, ``team_2_c`` and canonical venue and city."""
    out = matches
    for side in ("team_1", "team_2"):
        out = canonicalize(out, side, team_map, "raw_name", {f"{side}_c": "canonical_name"})
    return canonicalize(
        out,
        "venue",
        venue_map,
        "raw_venue",
        {"venue": "canonical_venue", "city": "canonical_city"},
    )


def match_innings(
    innings: DataFrame,
    matches: DataFrame,
    team_map: DataFrame,
    venue_map: DataFrame,
    excluded: DataFrame,
) -> DataFrame:
    """Match context per (match, innings, revision), excluded matches left out.

    Names are resolved here, at one row per innings, and not on the ball table.
    The batting side is what the innings says; the other match team bowls, team_1
    where the batting side is neither.
    """
    context = _canonical_matches(matches, team_map, venue_map).drop("match_type", "year")
    sides = innings.select(
        "match_id", "innings_number", "revision", "batting_team", "super_over"
    ).join(excluded.select("match_id"), "match_id", "left_anti")
    named = canonicalize(
        sides, "batting_team", team_map, "raw_name", {"batting_team_c": "canonical_name"}
    )
    joined = named.join(context, ["match_id", "revision"])
    return joined.selectExpr(
        "match_id",
        "innings_number",
        "revision",
        "match_date",
        "season",
        "gender",
        "team_type",
        "batting_team_c AS batting_team",
        "CASE WHEN batting_team = team_1 THEN team_2_c ELSE team_1_c END AS bowling_team",
        "venue",
        "city",
        "outcome_winner",
        "outcome_result",
        "outcome_method",
        "balls_per_over",
        "super_over",
        "event_name",
    )


def ball_by_ball(deliveries: DataFrame, context: DataFrame) -> DataFrame:
    """Balls with match context, by a single join of the fact table.

    ``deliveries`` is staged, so only rows of a match's winning revision are left; those
    without a match have no context and go here.
    """
    joined = deliveries.join(context, ["match_id", "innings_number", "revision"])
    return joined.select(*BALL_BY_BALL, *BALL_EXTRAS)


def match_results(
    matches: DataFrame, team_map: DataFrame, venue_map: DataFrame
) -> DataFrame:
    """One row per match under canonical names, with result flags.  Excluded matches
    are included.  The flags on the result text are NULL where there is none."""
    m = _canonical_matches(matches, team_map, venue_map)

    def as_team(c: str) -> str:
        return f"CASE WHEN {c} = team_1 THEN team_1_c WHEN {c} = team_2 THEN team_2_c ELSE {c} END AS {c}"

    replaced = ("team_1", "team_2", "toss_winner", "outcome_winner")
    resolved = m.selectExpr(
        *[c for c in m.columns if c not in replaced],
        as_team("toss_winner"),
        as_team("outcome_winner"),
        "outcome_winner IS NOT NULL AS has_result",
        "outcome_result = 'tie' AS is_tie",
        "outcome_result = 'draw' AS is_draw",
        "outcome_result = 'no result' AS is_no_result",
    ).withColumnsRenamed({"team_1_c": "team_1", "team_2_c": "team_2"})
    return resolved.select(*MATCH_RESULTS)

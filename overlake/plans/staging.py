"""Silver -> staging: one row per key, typed, with defaults.

Every silver table carries the document revision.  The newest revision of a match
wins as a whole: child rows of an older one never survive, also where a correction
removed them.  They go first, by a join with one narrow row per match, so only rows of
winning revisions are compared with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from overlake.operators.versions import dedupe

_INNINGS_KEY = ["match_id", "innings_number"]
_DELIVERY_KEY = ["match_id", "innings_number", "over_number", "ball_in_over"]
_PLAYER_KEY = ["match_id", "player_name", "team"]
# Where rows are sorted for de-duplication: those of an over together, which also packs them well.
_OVER = ["match_id", "innings_number", "over_number"]


def _default(value: str, *names: str) -> dict[str, Column]:
    return {n: F.expr(f"coalesce({n}, {value})") for n in names}


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"year": F.expr("try_cast(year AS int)"), **_default("1", "revision")}
    )


def stage_matches(matches: DataFrame) -> DataFrame:
    latest = dedupe(_typed(matches), ["match_id"], ["revision DESC"])
    return latest.withColumns(
        {
            "match_date": F.expr("try_cast(match_date AS date)"),
            **_default("false", "toss_uncontested"),
        }
    )


def stage_innings(innings: DataFrame, stg_matches: DataFrame) -> DataFrame:
    return dedupe(current_only(_typed(innings), stg_matches), [*_INNINGS_KEY, "revision"]).withColumns(
        {
            **_default("false", "declared", "forfeited", "super_over"),
            **_default("0", "penalty_runs_pre", "penalty_runs_post"),
        }
    )


def stage_deliveries(deliveries: DataFrame, stg_matches: DataFrame) -> DataFrame:
    """One row per ball.  Rows are placed by over, so even a match with very many
    rows spreads over all tasks.  Files that only have the joined fielders' names get the
    list from them."""
    return dedupe(current_only(_typed(deliveries), stg_matches), [*_DELIVERY_KEY, "revision"], place=_OVER).withColumns(
        {
            **_default("false", "runs_non_boundary"),
            **_default("split(wicket_fielders, ', ')", "wicket_fielders_arr"),
        }
    )


def stage_players(players: DataFrame, stg_matches: DataFrame) -> DataFrame:
    return dedupe(current_only(_typed(players), stg_matches), [*_PLAYER_KEY, "revision"], place=["match_id", "player_name"])


def current_only(rows: DataFrame, stg_matches: DataFrame) -> DataFrame:
    """Rows of each match's winning revision.  Rows without a match are kept, so that
    the relationship check can find them."""
    winning = stg_matches.selectExpr("match_id", "revision AS __winning")
    return (
        rows.join(winning, "match_id", "left")
        .filter("__winning IS NULL OR revision = __winning")
        .drop("__winning")
    )

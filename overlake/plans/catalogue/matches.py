"""Results between teams, toss, margins, awards, venues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from overlake.functions import flag_sum, named, ratio_sql
from overlake.operators.ranking import top_n
from overlake.plans.catalogue._shared import down, up


def team_record(t, team: str, match_type: str = "odi") -> DataFrame:
    """One row for the matches in which the team is listed first, one for second."""
    sides = "inline(array(named_struct('listed', 1, 'team', team_1, 'other', team_2), named_struct('listed', 2, 'team', team_2, 'other', team_1)))"
    rows = (
        t.match_results.filter(F.col("match_type") == match_type)
        .filter((F.col("team_1") == team) | (F.col("team_2") == team))
        .selectExpr("outcome_winner", "is_tie", "has_result", sides)
        .filter(F.col("team") == team)
    )
    wins = "sum(cast(outcome_winner = team AS int))"
    figures = named(
        played="count(*)",
        won=wins,
        lost="sum(cast(outcome_winner = other AS int))",
        tied="sum(cast(is_tie AS int))",
        no_result="sum(cast(NOT has_result AS int))",
        win_pct=ratio_sql(wins, "sum(cast(has_result AS int))", 1, times=100),
    )
    return rows.groupBy("listed", "team").agg(*figures).orderBy("listed").drop("listed")


def head_to_head(t, team_a: str, team_b: str) -> DataFrame:
    pair = ((F.col("team_1") == team_a) & (F.col("team_2") == team_b)) | (
        (F.col("team_1") == team_b) & (F.col("team_2") == team_a)
    )
    return (
        t.match_results.filter(F.col("has_result") & pair)
        .groupBy("match_type")
        .agg(
            F.count("*").alias("played"),
            F.sum((F.col("outcome_winner") == team_a).cast("int")).alias("team_a_wins"),
            F.sum((F.col("outcome_winner") == team_b).cast("int")).alias("team_b_wins"),
            flag_sum("is_tie").alias("ties"),
        )
        .orderBy(up("match_type"))
    )


def toss_advantage(t, match_types: Sequence[str] = ("t20", "odi", "test")) -> DataFrame:
    rows = t.match_results.filter(F.col("has_result") & F.col("match_type").isin(*match_types))
    kept = "sum(cast(toss_winner = outcome_winner AS int))"
    figures = named(
        matches="count(*)",
        toss_winner_won=kept,
        toss_win_pct=ratio_sql(kept, "count(*)", 1, times=100),
    )
    counted = rows.groupBy("match_type", "toss_decision").agg(*figures)
    return counted.orderBy(up("match_type"), up("toss_decision"))


def biggest_run_margins(t, match_type: str = "t20", n: int = 20) -> DataFrame:
    rows = t.match_results.filter(
        (F.col("match_type") == match_type) & F.col("outcome_by_runs").isNotNull()
    )
    return top_n(rows, [down("outcome_by_runs"), up("match_id")], n).select(
        "team_1", "team_2", "outcome_winner", "outcome_by_runs", "match_date", "venue"
    )


def player_of_match_awards(t, n: int = 20) -> DataFrame:
    counted = (
        t.match_results.filter(F.col("player_of_match").isNotNull())
        .groupBy(F.col("player_of_match").alias("player"), "match_type")
        .agg(F.count("*").alias("awards"))
    )
    return top_n(counted, [down("awards"), up("player"), up("match_type")], n)


def venue_counts(t, n: int = 30) -> DataFrame:
    counted = t.match_results.groupBy("venue", "city", "match_type").agg(
        F.count("*").alias("matches"),
        F.min("match_date").alias("first_match"),
        F.max("match_date").alias("last_match"),
    )
    return top_n(
        counted, [down("matches"), up("venue"), up("city"), up("match_type")], n
    )

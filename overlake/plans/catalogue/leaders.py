"""Leaderboards over career and innings tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from overlake.functions import named, ratio_sql
from overlake.operators.ranking import top_n
from overlake.plans.catalogue._shared import down, regular, up


def _career_list(table, match_type, qualify, order, columns, n) -> DataFrame:
    rows = table.filter(F.col("match_type") == match_type)
    if qualify is not None:
        rows = rows.filter(qualify)
    return top_n(rows, [order, up("player_name")], n).select(*columns.split())


def top_run_scorers(t, match_type: str = "odi", min_inns: int = 50, n: int = 20) -> DataFrame:
    return _career_list(
        t.batting_career, match_type, F.col("innings") >= min_inns, down("total_runs"),
        "player_name matches innings total_runs highest_score batting_avg batting_sr "
        "centuries fifties", n,
    )


def top_strike_rates(t, match_type: str = "t20", min_inns: int = 30, n: int = 20) -> DataFrame:
    return _career_list(
        t.batting_career, match_type, F.col("innings") >= min_inns, down("batting_sr"),
        "player_name innings total_runs batting_avg batting_sr total_sixes total_fours", n,
    )


def most_centuries(t, match_type: str = "test", n: int = 20) -> DataFrame:
    return _career_list(
        t.batting_career, match_type, None, down("centuries"),
        "player_name matches innings centuries fifties total_runs batting_avg "
        "first_year last_year", n,
    )


def player_formats(t, player: str) -> DataFrame:
    rows = t.batting_career.filter(F.col("player_name") == player)
    return rows.select(
        "player_name", "match_type", "matches", "innings", "total_runs",
        "batting_avg", "batting_sr", "centuries", "fifties",
    ).orderBy(up("match_type"))


def _batting_list(t, match_type, order, columns, n) -> DataFrame:
    rows = t.batting.filter(F.col("match_type") == match_type)
    unique = [up("match_id"), up("innings_number"), up("player_name")]
    return top_n(rows, [order, *unique], n).select(*columns.split())


def highest_scores(t, match_type: str = "odi", n: int = 20) -> DataFrame:
    return _batting_list(
        t, match_type, down("runs"),
        "player_name batting_team bowling_team match_date runs balls_faced strike_rate "
        "fours sixes not_out", n,
    )


def most_sixes_innings(t, match_type: str = "t20", n: int = 20) -> DataFrame:
    return _batting_list(
        t, match_type, down("sixes"),
        "player_name batting_team bowling_team match_date runs sixes fours balls_faced", n,
    )


def average_trend(t, player: str, match_type: str = "odi") -> DataFrame:
    rows = t.batting.filter(
        (F.col("player_name") == player) & (F.col("match_type") == match_type)
    ).filter("NOT super_over")
    per_year = rows.groupBy("year").agg(
        *named(
            matches="count(DISTINCT match_id)",
            runs="sum(runs)",
            avg=ratio_sql("sum(runs)", "sum(dismissals)"),
        )
    )
    return per_year.orderBy(up("year"))


def top_wicket_takers(t, match_type: str = "odi", min_inns: int = 50, n: int = 20) -> DataFrame:
    return _career_list(
        t.bowling_career, match_type, F.col("innings_bowled") >= min_inns,
        down("total_wickets"),
        "player_name matches innings_bowled total_wickets bowling_avg economy bowling_sr "
        "five_wicket_hauls", n,
    )


def best_economy(t, match_type: str = "t20", min_inns: int = 50, n: int = 20) -> DataFrame:
    return _career_list(
        t.bowling_career, match_type, F.col("innings_bowled") >= min_inns, up("economy"),
        "player_name innings_bowled total_wickets economy bowling_avg bowling_sr", n,
    )


def most_five_wicket_hauls(t, match_type: str = "test", n: int = 20) -> DataFrame:
    return _career_list(
        t.bowling_career, match_type, None, down("five_wicket_hauls"),
        "player_name matches total_wickets five_wicket_hauls bowling_avg economy "
        "first_year last_year", n,
    )


def best_bowling_innings(t, n: int = 20) -> DataFrame:
    order = [
        down("wickets_credited"), up("runs_conceded"),
        up("match_id"), up("innings_number"), up("player_name"),
    ]
    return top_n(t.bowling.filter("NOT super_over"), order, n).select(
        "player_name", "bowling_team", "batting_team", "match_date", "match_type",
        "wickets_credited", "runs_conceded", "legal_deliveries",
    )


def wicket_kinds(t) -> DataFrame:
    counted = (
        t.wickets.groupBy("wicket_kind").agg(F.count("*").alias("wickets"))
    )
    return counted.orderBy(down("wickets"), up("wicket_kind"))


def economy_by_over(t, match_type: str = "t20", strict: bool = False) -> DataFrame:
    """Economy per over.  The divisor is the balls less the *runs* from wides, no-balls
    kept; ``strict`` divides by legal balls."""
    legal = "sum(legal)" if strict else "(sum(deliveries) - sum(wide_runs))"
    rows = t.overs.filter((F.col("match_type") == match_type) & regular())
    figures = named(
        balls="sum(deliveries)",
        runs="sum(runs)",
        economy=ratio_sql("sum(runs)", legal, 2, times=6),
    )
    return rows.groupBy("over_number").agg(*figures).orderBy(up("over_number"))

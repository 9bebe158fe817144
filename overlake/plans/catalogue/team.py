"""A team's all-time league figures, under one or several names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import count_when, named, overs_sql, ratio_sql, round_half_up_sql
from overlake.operators.ranking import top_n
from overlake.plans.catalogue._shared import (
    LEAGUE,
    down,
    league_innings,
    league_matches,
    league_rows,
    opponent,
    record,
    up,
    with_outcome,
)

Names = Sequence[str]


def _own_matches(t, league: str, names: Names) -> DataFrame:
    return with_outcome(league_matches(t, league, names), names)


def team_seasons(t, names: Names, league: str = LEAGUE) -> DataFrame:
    """Record per season under the name used most, ties to the first by name."""
    name = F.when(F.col("team_1").isin(*names), F.col("team_1")).otherwise(F.col("team_2"))
    return (
        _own_matches(t, league, names)
        .groupBy("season")
        .agg(F.mode(name, deterministic=True).alias("team"), *record())
        .orderBy(up("season"))
    )


def team_by_stage(t, names: Names, league: str = LEAGUE) -> DataFrame:
    stage = F.expr("coalesce(event_stage, 'League') AS stage")
    rows = _own_matches(t, league, names).groupBy(stage).agg(*record())
    return rows.orderBy(down("played"), up("stage"))


def team_vs_opponents(t, names: Names, league: str = LEAGUE) -> DataFrame:
    rows = _own_matches(t, league, names).groupBy(opponent(names).alias("opponent"))
    return rows.agg(*record()).orderBy(down("played"), down("won"), up("opponent"))


def team_toss(t, names: Names, league: str = LEAGUE) -> DataFrame:
    rows = _own_matches(t, league, names).filter("has_result")
    called = "sum(CASE WHEN called THEN 1 ELSE 0 END)"
    return rows.withColumn("called", F.col("toss_winner").isin(*names)).agg(
        *named(
            matches="count(*)",
            toss_won=called,
            toss_win_pct=ratio_sql(called, "count(*)", 1, times=100),
        ),
        count_when("called AND toss_decision = 'bat'").alias("chose_bat"),
        count_when("called AND toss_decision = 'field'").alias("chose_field"),
        count_when("called AND won").alias("won_toss_won_match"),
        count_when("NOT called AND won").alias("lost_toss_won_match"),
    )


def team_toss_decision(t, names: Names, league: str = LEAGUE) -> DataFrame:
    rows = _own_matches(t, league, names).filter("has_result")
    wins = "sum(CASE WHEN won THEN 1 ELSE 0 END)"
    figures = named(
        times_chosen="count(*)", won=wins, win_pct=ratio_sql(wins, "count(*)", 1, times=100)
    )
    called = rows.filter(F.col("toss_winner").isin(*names))
    return called.groupBy(F.col("toss_decision").alias("decision")).agg(*figures).orderBy(up("decision"))


# totals per innings ----------------------------------------------------------


def _innings_totals(t, side: str, names: Names, league: str, **measures: str) -> DataFrame:
    """Sums of over figures per innings in which one of ``names`` is the given side."""
    return (
        league_rows(t, t.overs, league)
        .filter(F.col(side).isin(*names))
        .groupBy("match_id", "innings_number", "match_date", "season")
        .agg(*named(**{n: f"sum({m})" for n, m in measures.items()}))
    )


def _batting_totals(t, names: Names, league: str) -> DataFrame:
    return _innings_totals(
        t, "batting_team", names, league,
        team_total="runs", wickets_lost="team_wkts", fours="fours", sixes="sixes",
    )


def _bowling_totals(t, names: Names, league: str) -> DataFrame:
    return _innings_totals(
        t, "bowling_team", names, league,
        runs_conceded="runs", legal="legal", wkts_taken="credited",
    )


def _mean(column: str) -> str:
    return round_half_up_sql(f"avg({column})", 1)


BATTING_SEASON = {
    "innings": "count(*)",
    "total_runs": "sum(team_total)",
    "avg_score": _mean("team_total"),
    "highest": "max(team_total)",
    "lowest": "min(team_total)",
    "avg_wkts_lost": _mean("wickets_lost"),
    "fours": "sum(fours)",
    "sixes": "sum(sixes)",
}


def team_batting_seasons(t, names: Names, league: str = LEAGUE) -> DataFrame:
    return _batting_totals(t, names, league).groupBy("season").agg(*named(**BATTING_SEASON)).orderBy(up("season"))


def _scorecard(t, totals: DataFrame, names: Names, order, n: int, runs: str, wickets: str, score: str) -> DataFrame:
    """The first ``n`` innings in ``order``, with opponent, stage and score text; the
    match is looked up for those rows only."""
    best = top_n(totals, [order, up("match_id"), up("innings_number")], n)
    context = t.match_results.select("match_id", opponent(names).alias("vs"), "event_stage")
    text = F.expr(f"concat({runs}, '/', {wickets})")
    return (
        best.join(context, "match_id")
        .orderBy(order, up("match_id"), up("innings_number"))
        .select("season", "match_date", "vs", "event_stage", text.alias(score), runs)
    )


def team_highest_totals(t, names: Names, n: int = 10, league: str = LEAGUE) -> DataFrame:
    totals = _batting_totals(t, names, league)
    return _scorecard(t, totals, names, down("team_total"), n, "team_total", "wickets_lost", "score")


def team_lowest_totals(
    t, names: Names, n: int = 10, min_wkts: int = 8, league: str = LEAGUE
) -> DataFrame:
    """Lowest totals among innings that lost at least ``min_wkts`` wickets."""
    totals = _batting_totals(t, names, league).filter(F.col("wickets_lost") >= min_wkts)
    return _scorecard(t, totals, names, up("team_total"), n, "team_total", "wickets_lost", "score")


BOWLING_SEASON = {
    "innings": "count(*)",
    "avg_conceded": _mean("runs_conceded"),
    "best_defence": "min(runs_conceded)",
    "most_conceded": "max(runs_conceded)",
    "avg_wkts": _mean("wkts_taken"),
    "economy": ratio_sql("sum(runs_conceded)", "sum(legal)", 2, times=6),
}


def team_bowling_seasons(t, names: Names, league: str = LEAGUE) -> DataFrame:
    return _bowling_totals(t, names, league).groupBy("season").agg(*named(**BOWLING_SEASON)).orderBy(up("season"))


def team_lowest_conceded(t, names: Names, n: int = 10, league: str = LEAGUE) -> DataFrame:
    totals = _bowling_totals(t, names, league)
    return _scorecard(
        t, totals, names, up("runs_conceded"), n, "runs_conceded", "wkts_taken", "score_conceded"
    )


# performers ------------------------------------------------------------------


# Aggregates over batting innings, as SQL by name; balls include wides.
BATTING = {
    "mat": "count(DISTINCT match_id)",
    "inns": "count(*)",
    "no": "sum(cast(not_out AS int))",
    "runs": "sum(runs)",
    "hs": "max(runs)",
    "avg": ratio_sql("sum(runs)", "sum(dismissals)"),
    "bf": "sum(balls_faced)",
    "sr": ratio_sql("sum(runs)", "sum(balls_faced)", times=100),
    "50s": "sum(CASE WHEN runs >= 50 AND runs < 100 THEN 1 ELSE 0 END)",
    "100s": "sum(CASE WHEN runs >= 100 THEN 1 ELSE 0 END)",
    "4s": "sum(fours)",
    "6s": "sum(sixes)",
}


def batting_summary() -> list[Column]:
    """Aggregates over batting innings."""
    return named(**BATTING)


def bowling_figures(*hauls: str) -> dict[str, str]:
    """Aggregates over bowling innings, as SQL by name; runs include byes.  ``hauls`` names
    counts of innings by their least wickets, the first character."""
    runs, balls, wkts = "sum(runs_conceded)", "sum(legal_deliveries)", "sum(wickets_credited)"
    return dict(
        mat="count(DISTINCT match_id)",
        inns="count(*)",
        overs=overs_sql(balls),
        balls=balls,
        runs=runs,
        wkts=wkts,
        avg=ratio_sql(runs, wkts),
        econ=ratio_sql(runs, balls, times=6),
        sr=ratio_sql(balls, wkts),
        **{h: f"sum(CASE WHEN wickets_credited >= {int(h[0])} THEN 1 ELSE 0 END)" for h in hauls},
    )


def bowling_summary(*hauls: str) -> list[Column]:
    """Aggregates over bowling innings."""
    return named(**bowling_figures(*hauls))


def team_top_batters(
    t, names: Names, n: int | None = 20, league: str = LEAGUE, season: str | None = None
) -> DataFrame:
    rows = league_innings(t, t.batting, league, season).filter(F.col("batting_team").isin(*names))
    per_player = rows.groupBy(F.col("player_name").alias("batter")).agg(*batting_summary())
    return top_n(per_player, [down("runs"), up("batter")], n)


def team_top_bowlers(
    t, names: Names, n: int | None = 20, league: str = LEAGUE, season: str | None = None,
    hauls: Sequence[str] = ("4w+", "5w+"),
) -> DataFrame:
    rows = league_innings(t, t.bowling, league, season).filter(F.col("bowling_team").isin(*names))
    per_player = rows.groupBy(F.col("player_name").alias("bowler")).agg(*bowling_summary(*hauls))
    return top_n(per_player, [down("wkts"), up("bowler")], n)


def team_margins(
    t, names: Names, side: str = "won", unit: str = "runs", n: int = 10, league: str = LEAGUE
) -> DataFrame:
    """Biggest wins or losses by runs or by wickets."""
    margin = {"runs": "outcome_by_runs", "wickets": "outcome_by_wickets"}[unit]
    decided = {"won": "won", "lost": "lost"}[side]
    rows = _own_matches(t, league, names).filter(decided).filter(f"{margin} IS NOT NULL")
    return top_n(rows, [down(margin), up("match_id")], n).select(
        "season", "match_date", opponent(names).alias("vs"), "event_stage",
        F.col(margin).alias(f"{side}_by_{unit}"),
    )

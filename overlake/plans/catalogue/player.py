"""One player's league figures, innings by innings.

Here balls faced leave wides out, runs conceded leave byes and leg-byes out, and
being retired hurt counts as out; career tables differ in all three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import count_when, format_overs, named, overs_sql, ratio, ratio_sql
from overlake.operators.ranking import top_n
from overlake.plans.catalogue._shared import (
    LEAGUE,
    down,
    in_league,
    league_rows,
    regular,
    up,
)


def batting_log(t, player: str, league: str = LEAGUE) -> DataFrame:
    """The player's innings: runs, balls, fours, sixes, dismissed, faced.

    Read from the participation table, where a player's rows lie together.  Whether the
    player faced a ball anywhere in the match was decided there over all innings, super
    overs included.
    """
    rows = t.took_part.filter(
        (F.col("player_name") == player) & in_league(league) & regular()
    )
    return rows.filter("balls_faced > 0 OR out_any OR NOT batted").selectExpr(
        "match_id", "innings_number", "match_date", "season", "batting_team", "bowling_team",
        "runs", "non_wides AS balls", "fours", "sixes", "balls_faced AS faced",
        "cast(out_any AS int) AS dismissed",
    )


# Figures over rows of the logs, as SQL by name.
SUMMARY = {
    "mat": "count(DISTINCT match_id)",
    "inns": "count(*)",
    "no": "sum(1 - dismissed)",
    "runs": "sum(runs)",
    "hs": "max(runs)",
    "ave": ratio_sql("sum(runs)", "sum(dismissed)"),
    "bf": "sum(balls)",
    "sr": ratio_sql("sum(runs)", "sum(balls)", times=100),
    "100": "sum(CASE WHEN runs >= 100 THEN 1 ELSE 0 END)",
    "50": "sum(CASE WHEN runs >= 50 AND runs < 100 THEN 1 ELSE 0 END)",
    "0": "sum(CASE WHEN runs = 0 AND dismissed = 1 THEN 1 ELSE 0 END)",
    "4s": "sum(fours)",
    "6s": "sum(sixes)",
}
TREND = {
    "matches": "count(DISTINCT match_id)",
    "innings": "count(*)",
    "runs": "sum(runs)",
    "highest": "max(runs)",
    "avg": ratio_sql("sum(runs)", "sum(dismissed)"),
    "sr": ratio_sql("sum(runs)", "sum(balls)", times=100),
    "fifties_plus": "sum(CASE WHEN runs >= 50 THEN 1 ELSE 0 END)",
}
DISMISSALS = {
    "innings": "count(*)",
    "dismissed": "sum(dismissed)",
    "not_out": "sum(1 - dismissed)",
    "runs": "sum(runs)",
    "avg": ratio_sql("sum(runs)", "sum(dismissed)"),
}


def _summary() -> list[Column]:
    return named(**SUMMARY)


def player_batting(t, player: str, league: str = LEAGUE) -> DataFrame:
    return batting_log(t, player, league).agg(*_summary())


def player_batting_career(t, player: str, league: str = LEAGUE) -> DataFrame:
    """:func:`player_batting` under spelled-out names."""
    short = player_batting(t, player, league).withColumn("player_name", F.lit(player))
    return short.selectExpr(
        "player_name", "mat AS matches", "inns AS innings", "runs AS total_runs",
        "hs AS highest_score", "ave AS batting_avg", "sr AS strike_rate",
        "`100` AS centuries", "`50` AS fifties", "`4s` AS total_fours", "`6s` AS total_sixes",
    )


def player_batting_by_season(t, player: str, league: str = LEAGUE) -> DataFrame:
    """Summary per season with the side played for most, ties to the first by name."""
    team = F.mode("batting_team", deterministic=True).alias("team")
    seasons = batting_log(t, player, league).groupBy("season").agg(team, *_summary())
    return seasons.orderBy(up("season"))


def player_batting_trend(t, player: str, league: str = LEAGUE) -> DataFrame:
    """Seasons in short, with all scores of fifty or more in one count."""
    return batting_log(t, player, league).groupBy("season").agg(*named(**TREND)).orderBy(up("season"))


RATE = ratio_sql("runs", "balls", 1, times=100)


def player_top_innings(t, player: str, n: int = 20, league: str = LEAGUE) -> DataFrame:
    faced = batting_log(t, player, league).filter("faced > 0")
    best = top_n(faced, [down("runs"), up("match_id"), up("innings_number")], n)
    return best.selectExpr(
        "season", "match_date", "batting_team", "bowling_team AS vs", "runs",
        "dismissed = 0 AS not_out", "balls", f"{RATE} AS sr", "fours", "sixes",
    )


def player_innings_log(t, player: str, league: str = LEAGUE) -> DataFrame:
    log = batting_log(t, player, league)
    return log.orderBy(down("match_date"), up("match_id"), up("innings_number")).selectExpr(
        "season", "match_date", "batting_team", "bowling_team AS vs", "runs",
        "balls AS balls_faced", f"{RATE} AS strike_rate", "fours", "sixes",
        "dismissed = 0 AS not_out",
    )


def player_dismissals_by_season(t, player: str, league: str = LEAGUE) -> DataFrame:
    return batting_log(t, player, league).groupBy("season").agg(*named(**DISMISSALS)).orderBy(up("season"))


def player_innings_diagnostic(t, player: str, league: str = LEAGUE) -> DataFrame:
    log = batting_log(t, player, league)
    return log.orderBy(up("match_date"), up("match_id"), up("innings_number")).selectExpr(
        "season", "match_date", "batting_team", "runs", "balls", "dismissed > 0 AS dismissed"
    )


# bowling ---------------------------------------------------------------------


def bowling_log(t, player: str, league: str = LEAGUE, season: str | None = None) -> DataFrame:
    """The player's spells per innings, runs as charged to the bowler."""
    rows = t.bowling.filter((F.col("player_name") == player) & in_league(league) & regular())
    if season is not None:
        rows = rows.filter(F.col("season") == season)
    return rows.selectExpr(
        "match_id", "innings_number", "match_date", "season", "bowling_team",
        "total_deliveries AS deliveries", "legal_deliveries AS balls", "charged_runs AS runs",
        "wickets_credited AS wkts", "wides", "no_balls AS nb", "maidens AS mdns",
    )


FIGURES = {
    "mat": "count(DISTINCT match_id)",
    "inns": "count(*)",
    "overs": overs_sql("sum(balls)"),
    "balls": "sum(balls)",
    "runs": "sum(runs)",
    "wkts": "sum(wkts)",
    "bbi": "max_by(concat(wkts, '/', runs), struct(wkts, -runs))",
    "ave": ratio_sql("sum(runs)", "sum(wkts)"),
    "econ": ratio_sql("sum(runs)", "sum(balls)", times=6),
    "sr": ratio_sql("sum(balls)", "sum(wkts)"),
    "4w": "sum(CASE WHEN wkts >= 4 THEN 1 ELSE 0 END)",
    "5w": "sum(CASE WHEN wkts >= 5 THEN 1 ELSE 0 END)",
}


def _figures() -> list[Column]:
    return named(**FIGURES)


def player_bowling(t, player: str, league: str = LEAGUE) -> DataFrame:
    maidens = named(mdns="coalesce(sum(mdns), 0)")
    return (
        bowling_log(t, player, league)
        .agg(*_figures(), *maidens)
        .select(
            "mat", "inns", "overs", "balls", "mdns", "runs", "wkts", "bbi", "ave",
            "econ", "sr", "4w", "5w",
        )
    )


def player_bowling_by_season(t, player: str, league: str = LEAGUE) -> DataFrame:
    return bowling_log(t, player, league).groupBy("season").agg(*_figures()).orderBy(up("season"))


def _with_sides(t, spells: DataFrame) -> DataFrame:
    """Adds the match teams and the opponent; joined at one row per innings."""
    sides = t.match_results.select("match_id", "team_1", "team_2")
    vs = "CASE WHEN team_1 = bowling_team THEN team_2 ELSE team_1 END"
    return spells.join(sides, "match_id").withColumn("vs", F.expr(vs))


def player_best_bowling(t, player: str, n: int = 20, league: str = LEAGUE) -> DataFrame:
    spells = _with_sides(t, bowling_log(t, player, league))
    order = [down("wkts"), up("runs"), up("match_id"), up("innings_number")]
    return top_n(spells, order, n).select(
        "season", "match_date", "bowling_team", "vs", "wkts", "runs", "balls",
        format_overs("balls").alias("overs"),
    )


def player_bowling_log(t, player: str, season: str = "2025", league: str = LEAGUE) -> DataFrame:
    spells = _with_sides(t, bowling_log(t, player, league, season))
    return spells.orderBy(up("match_date"), up("match_id"), up("innings_number")).select(
        "match_date", "vs", format_overs("balls").alias("overs"), "balls", "runs", "wkts",
        "wides", "nb", ratio("runs", "balls", times=6).alias("econ"), "match_id",
    )


def player_bowling_diagnostic(
    t, player: str, season: str = "2025", league: str = LEAGUE
) -> DataFrame:
    """Raw counters per spell; shows missing sides and dates."""
    spells = _with_sides(t, bowling_log(t, player, league, season))
    return spells.orderBy(up("match_date"), up("innings_number"), up("match_id")).select(
        "match_id", "innings_number", "match_date", "bowling_team", "team_1", "team_2",
        "deliveries", F.expr("balls AS legal_del"), "runs", "wkts",
    )


# fielding --------------------------------------------------------------------


def _fielding(wickets: DataFrame, player: str, legacy_like: bool) -> DataFrame:
    """Adds ``fielded`` and ``bowled``: whether the player took part as either."""
    if legacy_like:
        fielded = F.col("wicket_fielders").contains(player)
    else:
        fielded = F.array_contains("wicket_fielders_arr", player)
    return wickets.withColumns({"fielded": fielded, "bowled": F.col("bowler") == player})


CATCHES = {
    "catches": "wicket_kind = 'caught' AND fielded",
    "caught_and_bowled": "wicket_kind = 'caught and bowled' AND bowled",
    "stumpings": "wicket_kind = 'stumped' AND fielded",
    "run_outs": "wicket_kind = 'run out' AND fielded",
}


def _fielding_sums() -> list[Column]:
    return [count_when(cond).alias(name) for name, cond in CATCHES.items()]


def player_fielding(
    t, player: str, league: str = LEAGUE, legacy_like: bool = False
) -> DataFrame:
    """Fielding totals.  Names are compared whole; ``legacy_like`` looks for the name
    inside the joined text, which also counts longer names that contain it."""
    wickets = league_rows(t, t.wickets, league)
    return _fielding(wickets, player, legacy_like).agg(*_fielding_sums())


def player_fielding_by_season(
    t, player: str, league: str = LEAGUE, legacy_like: bool = False
) -> DataFrame:
    wickets = league_rows(t, t.wickets, league)
    seasons = _fielding(wickets, player, legacy_like).groupBy("season")
    return seasons.agg(*_fielding_sums()).orderBy(up("season"))

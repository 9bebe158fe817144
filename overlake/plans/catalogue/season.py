"""One league season: all teams side by side, one team, one player."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import PHASES, named, overs_sql, phase_label, ratio_sql, round_half_up_sql
from overlake.operators.phases import phase_pivot
from overlake.operators.ranking import top_k_share, top_n
from overlake.plans.catalogue._shared import (
    LEAGUE,
    down,
    league_innings,
    league_matches,
    league_rows,
    opponent,
    record,
    result_code,
    up,
    with_outcome,
    won,
)
from overlake.plans.catalogue.team import (
    batting_summary,
    team_top_batters,
    team_top_bowlers,
)

Names = Sequence[str]

# Overs of any phase.
PHASE_OVERS = f"over_number BETWEEN {min(p[0] for p in PHASES.values())} AND {max(p[1] for p in PHASES.values())}"


def _sums(*names: str) -> list[Column]:
    return named(**{n: f"sum({n})" for n in names})


def _per_match(overs: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    """Sums per key with ``mat``, the number of matches.  Going through (key, match)
    turns the distinct count into a plain one and leaves a row per match to exchange."""
    by_match = overs.groupBy(*keys, "match_id").agg(*_sums(*measures))
    matches = F.count("*").alias("mat")
    if keys:
        return by_match.groupBy(*keys).agg(matches, *_sums(*measures))
    return by_match.agg(matches, *_sums(*measures))


# season record ---------------------------------------------------------------


def season_results(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    rows = league_matches(t, league, names, season)
    found = rows.orderBy(up("match_date"), up("match_id")).select(
        "match_date",
        opponent(names).alias("vs"),
        result_code(names).alias("result"),
        "outcome_method",
        *named(
            stage="coalesce(event_stage, 'League')",
            by_runs="outcome_by_runs",
            by_wkts="outcome_by_wickets",
        ),
    )
    return found.select("match_date", "vs", "stage", "result", "by_runs", "by_wkts", "outcome_method")


def season_summary(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    rows = league_matches(t, league, names, season)
    return with_outcome(rows, names).agg(*record())


# all teams -------------------------------------------------------------------


def _batter_runs(t, season: str, league: str) -> DataFrame:
    rows = league_innings(t, t.batting, league, season)
    return rows.groupBy(
        F.col("batting_team").alias("team"), F.col("player_name").alias("batter")
    ).agg(F.sum("runs").alias("runs"))


def _bowler_wickets(t, season: str, league: str) -> DataFrame:
    rows = league_innings(t, t.bowling, league, season)
    return rows.groupBy(
        F.col("bowling_team").alias("team"), F.col("player_name").alias("bowler")
    ).agg(F.sum("wickets_credited").alias("wkts"))


def _concentration(shares: DataFrame, k: int, measure: str, people: str) -> DataFrame:
    return shares.selectExpr(
        "team",
        f"total AS total_{measure}",
        f"top AS top{k}_{measure}",
        f"pct AS top{k}_pct",
        f"names AS top{k}_{people}",
    ).orderBy(down(f"top{k}_pct"), up("team"))


def batting_concentration(t, season: str, k: int = 3, league: str = LEAGUE) -> DataFrame:
    shares = top_k_share(_batter_runs(t, season, league), "team", "batter", "runs", k)
    return _concentration(shares, k, "runs", "players")


def batting_dominance(t, season: str, pct: float = 25.0, league: str = LEAGUE) -> DataFrame:
    """Batters with at least ``pct`` percent of their team's runs."""
    runs = _batter_runs(t, season, league)
    totals = runs.groupBy("team").agg(F.sum("runs").alias("total_runs"))
    share = ratio_sql("runs", "total_runs", None, times=100)
    return (
        runs.join(totals, "team")
        .filter(f"{share} >= {float(pct)}D")
        .selectExpr(
            "team", "batter", "runs", "total_runs",
            f"{round_half_up_sql(share, 1)} AS pct_of_team_runs",
        )
        .orderBy(down("pct_of_team_runs"), up("team"), up("batter"))
    )


def bowling_concentration(t, season: str, k: int = 3, league: str = LEAGUE) -> DataFrame:
    shares = top_k_share(_bowler_wickets(t, season, league), "team", "bowler", "wkts", k)
    return _concentration(shares, k, "wkts", "bowlers")


def batting_profile_sql(four_name: str, six_name: str) -> dict[str, str]:
    return {
        "avg_score": ratio_sql("bat_runs", "mat", 1),
        "avg_sr": ratio_sql("bat_runs", "non_wides", 1, times=100),
        four_name: ratio_sql("non_wides", "fours", 1),
        six_name: ratio_sql("non_wides", "sixes", 1),
        "dot_pct": ratio_sql("dots", "non_wides", 1, times=100),
        "boundary_pct": ratio_sql("(fours + sixes)", "non_wides", 1, times=100),
    }


_BATTING = ("bat_runs", "non_wides", "fours", "sixes", "dots")
_BOWLING = ("legal", "wkts", "runs", "dots", "non_wides", "wide_runs", "no_ball_runs")


def bowling_profile_sql(economy: str) -> dict[str, str]:
    return {
        "balls_per_wkt": ratio_sql("legal", "wkts", 1),
        economy: ratio_sql("runs", "legal", 2, times=6),
        "dot_pct": ratio_sql("dots", "non_wides", 1, times=100),
        "extras_per_match": ratio_sql("(wide_runs + no_ball_runs)", "mat", 2),
    }


def _team_overs(t, side: str, season: str, league: str) -> DataFrame:
    return league_rows(t, t.overs, league, season).withColumn("team", F.col(side))


def batting_profile(t, season: str, league: str = LEAGUE) -> DataFrame:
    """All teams; the score counts runs off the bat only."""
    sums = _per_match(_team_overs(t, "batting_team", season, league), ["team"], *_BATTING)
    profile = named(**batting_profile_sql("balls_per_4", "balls_per_6"))
    return sums.select("team", "mat", *profile).orderBy(down("avg_score"), up("team"))


def _phases_wide(
    t, side: str, season: str, league: str, runs: str, rate: str
) -> DataFrame:
    """All teams, four figures per phase side by side; ``runs`` and ``rate`` name two."""
    overs = _team_overs(t, side, season, league).filter(PHASE_OVERS)
    measures = {n: n for n in ("runs", "wkts", "legal", "non_wides", "fours", "sixes")}
    by_match = overs.groupBy("team", "match_id").agg(*phase_pivot("over_number", PHASES, measures))
    cells = [f"{p}_{m}" for p in PHASES for m in measures]
    sums = by_match.groupBy("team").agg(F.count("*").alias("mat"), *_sums(*cells))
    out: dict[str, str] = {}
    for p in PHASES:
        boundaries = f"({p}_fours + {p}_sixes)"
        out[f"{p}_{runs}"] = ratio_sql(f"{p}_runs", "mat", 1)
        out[f"{p}_wkts"] = ratio_sql(f"{p}_wkts", "mat", 2)
        out[f"{p}_{rate}"] = ratio_sql(f"{p}_runs", f"{p}_legal", 2, times=6)
        out[f"{p}_boundary_pct"] = ratio_sql(boundaries, f"{p}_non_wides", 1, times=100)
    return sums.select("team", *named(**out))


def batting_phases(t, season: str, league: str = LEAGUE) -> DataFrame:
    wide = _phases_wide(t, "batting_team", season, league, "runs", "rr")
    return wide.orderBy(down("pp_runs"), up("team"))


def bowling_profile(t, season: str, league: str = LEAGUE) -> DataFrame:
    sums = _per_match(_team_overs(t, "bowling_team", season, league), ["team"], *_BOWLING)
    return sums.select("team", *named(**bowling_profile_sql("economy"))).orderBy(up("economy"), up("team"))


def _match_phases(t, season: str, league: str) -> DataFrame:
    """Runs per match and pair of sides, in total and per phase, for matches with a
    winner, with ``outcome_winner``.  Overs are summed before the match is joined."""
    per_match = (
        league_rows(t, t.overs, league, season)
        .filter(PHASE_OVERS)
        .groupBy("match_id", "batting_team", "bowling_team")
        .agg(F.sum("runs").alias("all_runs"), *phase_pivot("over_number", PHASES, {"runs": "runs"}))
    )
    decided = league_matches(t, league, season=season).filter("has_result")
    return per_match.join(decided.select("match_id", "outcome_winner"), "match_id")


def phase_split_by_result(
    t, season: str, league: str = LEAGUE, swapped_bowling: bool = False
) -> DataFrame:
    """All teams: average score and powerplay score in wins and losses, made and
    conceded.  ``swapped_bowling`` exchanges wins and losses in the four bowling
    columns, as a long-standing version of this report does."""
    def role(side: str, role: str) -> str:
        cells = [
            f"'{r}_{c}', {f'{c}_runs' if r == role else 'cast(NULL AS bigint)'}"
            for r in ("bat", "bowl")
            for c in ("all", "pp")
        ]
        return f"named_struct('team', {side}, {', '.join(cells)})"

    roles = f"inline(array({role('batting_team', 'bat')}, {role('bowling_team', 'bowl')}))"
    per_team = (
        _match_phases(t, season, league)
        .selectExpr("match_id", "outcome_winner", roles)
        .groupBy("team", "match_id", "outcome_winner")
        .agg(*_sums("bat_all", "bat_pp", "bowl_all", "bowl_pp"))
        # Both roles are needed, as when joining batting to bowling.
        .filter("team IS NOT NULL AND bat_all IS NOT NULL AND bowl_all IS NOT NULL")
        .withColumn("won", F.expr("outcome_winner = team"))
    )

    def mean(won: bool, column: str) -> str:
        return round_half_up_sql(f"avg(CASE WHEN {'won' if won else 'NOT won'} THEN {column} END)", 1)

    figures = {"wins": "sum(cast(won AS int))", "losses": "sum(cast(NOT won AS int))"}
    for r in ("bat", "bowl"):
        for cell, label in (("all", "avg"), ("pp", "pp")):
            for letter, won_ in (("W", True), ("L", False)):
                flip = swapped_bowling and r == "bowl"
                figures[f"{r}_{label}_{letter}"] = mean(won_ != flip, f"{r}_{cell}")
    return per_team.groupBy("team").agg(*named(**figures)).orderBy(down("wins"), up("team"))


def bowling_phases(t, season: str, league: str = LEAGUE) -> DataFrame:
    wide = _phases_wide(t, "bowling_team", season, league, "conceded", "econ")
    return wide.orderBy(up("pp_econ"), up("team"))


# one team --------------------------------------------------------------------


def season_batters(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    return team_top_batters(t, names, None, league, season)


def season_bowlers(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    return team_top_bowlers(t, names, None, league, season, hauls=("4w+",))


def _top_share(rows: DataFrame, person: str, measure: str, share: str, k: int) -> DataFrame:
    """Largest ``k`` with their percentage of the sum over all rows."""
    total = rows.agg(F.sum(measure)).scalar()
    best = top_n(rows.withColumn("total", total), [down(measure), up(person)], k)
    return best.selectExpr(person, measure, f"{ratio_sql(measure, 'total', 1, times=100)} AS {share}")


def season_batter_share(t, names: Names, season: str, k: int = 3, league: str = LEAGUE) -> DataFrame:
    rows = (
        league_innings(t, t.batting, league, season)
        .filter(F.col("batting_team").isin(*names))
        .groupBy(F.col("player_name").alias("batter"))
        .agg(F.sum("runs").alias("runs"))
    )
    return _top_share(rows, "batter", "runs", "pct_of_team_runs", k)


def season_bowler_share(t, names: Names, season: str, k: int = 3, league: str = LEAGUE) -> DataFrame:
    rows = (
        league_innings(t, t.bowling, league, season)
        .filter(F.col("bowling_team").isin(*names))
        .groupBy(F.col("player_name").alias("bowler"))
        .agg(F.sum("wickets_credited").alias("wkts"))
    )
    return _top_share(rows, "bowler", "wkts", "pct_of_team_wkts", k)


def _side_overs(t, side: str, names: Names, season: str, league: str) -> DataFrame:
    return league_rows(t, t.overs, league, season).filter(F.col(side).isin(*names))


def season_batting_profile(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    overs = _side_overs(t, "batting_team", names, season, league)
    sums = _per_match(overs, [], *_BATTING)
    profile = batting_profile_sql("balls_per_four", "balls_per_six")
    return sums.select(*named(matches="mat", total_runs="bat_runs", **profile))


def season_bowling_profile(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    overs = _side_overs(t, "bowling_team", names, season, league)
    sums = _per_match(overs, [], *_BOWLING)
    return sums.select(*named(matches="mat", total_wkts="wkts", **bowling_profile_sql("avg_economy")))


def _phases_long(overs: DataFrame, runs: str, wkts: str, rate: str, bound: str) -> DataFrame:
    labelled = overs.filter(PHASE_OVERS).withColumn("phase", phase_label())
    measures = ("runs", "wkts", "legal", "non_wides", "dots", "fours", "sixes")
    sums = _per_match(labelled, ["phase"], *measures)
    figures = {
        runs: ratio_sql("runs", "mat", 1),
        wkts: ratio_sql("wkts", "mat", 2),
        rate: ratio_sql("runs", "legal", 2, times=6),
        "dot_pct": ratio_sql("dots", "non_wides", 1, times=100),
        bound: ratio_sql("(fours + sixes)", "non_wides", 1, times=100),
    }
    return sums.select("phase", *named(**figures)).orderBy(up("phase"))


def season_batting_phases(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    overs = _side_overs(t, "batting_team", names, season, league)
    return _phases_long(overs, "avg_runs", "avg_wkts_lost", "run_rate", "boundary_pct")


def season_bowling_phases(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    overs = _side_overs(t, "bowling_team", names, season, league)
    return _phases_long(overs, "avg_runs_conceded", "avg_wkts_taken", "economy", "boundary_pct_conceded")


def season_win_loss(t, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    """Averages per match in wins and in losses, batting and bowling.

    A row stands for all the season's matches the team did not win, its own or not;
    only its own enter the averages.
    """
    rows = _match_phases(t, season, league).withColumns(
        {
            "won": won(names),
            "bat": F.col("batting_team").isin(*names),
            "bowl": F.col("bowling_team").isin(*names),
        }
    )
    figures: dict[str, str] = {}
    for role, whole in (("bat", "score"), ("bowl", "conceded")):
        matches = f"count(DISTINCT CASE WHEN {role} THEN match_id END)"
        for cell in ("all", *PHASES):
            total = f"sum(CASE WHEN {role} THEN {cell}_runs ELSE 0 END)"
            label = f"{role}_avg_{whole}" if cell == "all" else f"{role}_{cell}_avg"
            figures[label] = ratio_sql(total, matches, 1)
    result = F.expr("CASE WHEN won THEN 'Won' ELSE 'Lost' END AS result")
    return rows.groupBy("won").agg(*named(**figures)).orderBy(down("won")).select(result, *figures)


# one player ------------------------------------------------------------------


def _player_matches(t, innings, side, player, names, season, league) -> DataFrame:
    rows = league_innings(t, innings, league, season).filter(
        (F.col("player_name") == player) & F.col(side).isin(*names)
    )
    context = league_matches(t, league, season=season).select(
        "match_id", opponent(names).alias("vs"), result_code(names).alias("result")
    )
    return rows.join(context, "match_id").orderBy(
        up("match_date"), up("match_id"), up("innings_number")
    )


def season_player_batting_log(t, player: str, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    rows = _player_matches(t, t.batting, "batting_team", player, names, season, league)
    return rows.selectExpr(
        "match_date", "vs", "result", "runs", "not_out", "balls_faced AS balls",
        f"{ratio_sql('runs', 'balls_faced', 1, times=100)} AS sr", "fours AS `4s`", "sixes AS `6s`",
    )


def season_player_batting(t, player: str, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    rows = league_innings(t, t.batting, league, season).filter(
        (F.col("player_name") == player) & F.col("batting_team").isin(*names)
    )
    return rows.agg(*batting_summary())


def season_player_bowling_log(t, player: str, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    rows = _player_matches(t, t.bowling, "bowling_team", player, names, season, league)
    return rows.selectExpr(
        "match_date", "vs", "result", f"{overs_sql('legal_deliveries')} AS overs",
        "legal_deliveries AS balls", "runs_conceded AS runs", "wickets_credited AS wkts",
        f"{ratio_sql('runs_conceded', 'legal_deliveries', 2, times=6)} AS econ",
    )


def powerplay_impact(t, player: str, names: Names, season: str, league: str = LEAGUE) -> DataFrame:
    """Team record in matches where the player was out in the powerplay, and in those
    where the player faced a ball in it and was not; always two rows."""
    first, last, _ = PHASES["pp"]
    dismissed = league_rows(t, t.wickets, league, season).filter(
        F.col("over_number").between(first, last) & (F.col("wicket_player_out") == player)
    )
    facing = league_rows(t, t.powerplay_batters, league, season).filter(F.col("player_name") == player)
    per_match = (
        dismissed.select("match_id", "batting_team", F.lit(1).alias("out"))
        .unionByName(facing.select("match_id", "batting_team", F.lit(0).alias("out")))
        .filter(F.col("batting_team").isin(*names))
        .groupBy("match_id")
        .agg(F.max("out").alias("out"))
    )
    decided = league_matches(t, league, season=season).filter("has_result")
    context = with_outcome(decided, names).select("match_id", "won", "lost", "has_result")

    def scenario(name: str, out: int) -> str:
        case = f"CASE WHEN out = {out} THEN"
        wins = f"sum({case} if(won, 1, 0) END)"
        pct = ratio_sql(wins, f"sum({case} cast(has_result AS int) END)", 1, then_times=100)
        return (
            f"named_struct('scenario', '{name}', 'matches', count_if(out = {out}), 'wins', {wins}, "
            f"'losses', sum({case} if(lost, 1, 0) END), 'win_pct', {pct})"
        )

    both = F.expr(f"array({scenario('Out in PP', 1)}, {scenario('Survived PP', 0)}) AS s")
    return per_match.join(context, "match_id").agg(both).selectExpr("inline(s)")

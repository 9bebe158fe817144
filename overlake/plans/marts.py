"""Player dimension and career tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from overlake.functions import count_when, named, ratio


# A match lies in one folder of (match_type, year), so matches counted per folder add up.
_FOLDER = ("match_type", "year")


def player_parts(players: DataFrame) -> DataFrame:
    """Per folder and player: matches, and the teams played for."""
    return players.groupBy(*_FOLDER, "player_name").agg(
        F.count_distinct("match_id").alias("matches"), F.array_sort(F.collect_set("team")).alias("teams")
    )


def player_ids(players: DataFrame) -> DataFrame:
    """Per folder, player and id the number of rows that have it."""
    return players.filter("cricsheet_id IS NOT NULL").groupBy(*_FOLDER, "player_name", "cricsheet_id").agg(
        F.count("*").alias("n")
    )


def dim_players(parts: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per player name: most frequent id (ties to the smallest), formats,
    teams and span of years, merged from the parts of all folders.

    Formats and teams are reduced to distinct pairs first, so no group collects one
    element per folder.
    """
    usual = ids.groupBy("player_name", "cricsheet_id").agg(F.sum("n").alias("n"))
    usual = usual.groupBy("player_name").agg(F.expr("min_by(cricsheet_id, struct(-n, cricsheet_id))").alias("cricsheet_id"))
    spans = parts.groupBy("player_name").agg(
        F.sum("matches").alias("total_matches"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )

    def listed(pairs: DataFrame, column: str, count: str, names: str) -> DataFrame:
        return pairs.distinct().groupBy("player_name").agg(
            F.count(column).alias(count),
            F.nullif(
                F.array_join(F.array_sort(F.collect_list(column)), ", "), F.lit("")
            ).alias(names),
        )

    formats = listed(parts.select("player_name", "match_type"), "match_type", "match_types_played", "match_types")
    teams = listed(parts.select("player_name", F.explode_outer("teams").alias("team")), "team", "teams_played_for", "teams")
    joined = spans.join(formats, "player_name").join(teams, "player_name")
    return joined.join(usual, "player_name", "left").select(
        "player_name",
        "cricsheet_id",
        "total_matches",
        "match_types_played",
        "match_types",
        "teams_played_for",
        "teams",
        "first_year",
        "last_year",
    )


def _merged(**names: str) -> list:
    """Sums, and for those named otherwise maxima, of parts."""
    return [F.expr(f"{how}({name})").alias(name) for name, how in names.items()]


_YEARS = {"first_year": "min(year)", "last_year": "max(year)"}


def batting_parts(innings: DataFrame) -> DataFrame:
    """Career batting per player and folder, super overs left out.

    A player's first innings of a match is marked where batting innings are made, so matches are
    summed, not compared.
    """
    return innings.filter("NOT super_over").groupBy(*_FOLDER, "player_name").agg(
        *named(
            matches="sum(cast(first_of_match AS int))",
            innings="count(*)",
            not_outs="sum(cast(not_out AS int))",
            total_runs="sum(runs)",
            highest_score="max(runs)",
            total_balls="sum(balls_faced)",
            total_fours="sum(fours)",
            total_sixes="sum(sixes)",
            total_dismissals="sum(dismissals)",
        ),
        count_when("runs >= 100").alias("centuries"),
        count_when("runs >= 50 AND runs < 100").alias("fifties"),
        count_when("runs = 0 AND NOT not_out").alias("ducks"),
    )


def batting_career(parts: DataFrame) -> DataFrame:
    """Career batting per player and format.  Balls include wides, unlike the strike rate
    per innings."""
    summed = (
        "matches innings not_outs total_runs total_balls total_fours total_sixes total_dismissals centuries fifties ducks"
    ).split()
    figures = parts.groupBy("player_name", "match_type").agg(
        *_merged(**dict.fromkeys(summed, "sum"), highest_score="max"), *named(**_YEARS)
    )
    return figures.select(
        "player_name", "match_type", "matches", "innings", "not_outs", "total_runs",
        "highest_score", "total_balls", "total_fours", "total_sixes", "total_dismissals",
        ratio("total_runs", "total_dismissals").alias("batting_avg"),
        ratio("total_runs", "total_balls", times=100).alias("batting_sr"),
        "centuries", "fifties", "ducks", "first_year", "last_year",
    )


def bowling_parts(innings: DataFrame) -> DataFrame:
    """Career bowling per player and folder, super overs left out."""
    return innings.filter("NOT super_over").groupBy(*_FOLDER, "player_name").agg(
        *named(
            matches="sum(cast(first_of_match AS int))",
            innings_bowled="count(*)",
            total_balls="sum(legal_deliveries)",
            total_runs="sum(runs_conceded)",
            total_wickets="sum(wickets_credited)",
            total_no_balls="sum(no_balls)",
            total_wides="sum(wides)",
            best_wickets="max(wickets_credited)",
        ),
        count_when("wickets_credited >= 5").alias("five_wicket_hauls"),
        count_when("wickets_credited >= 4").alias("four_plus_wicket_hauls"),
    )


def bowling_career(parts: DataFrame) -> DataFrame:
    """Career bowling per player and format.  The economy is per six balls whatever the
    format's over."""
    summed = (
        "matches innings_bowled total_balls total_runs total_wickets total_no_balls total_wides "
        "five_wicket_hauls four_plus_wicket_hauls"
    ).split()
    figures = parts.groupBy("player_name", "match_type").agg(
        *_merged(**dict.fromkeys(summed, "sum"), best_wickets="max"), *named(**_YEARS)
    )
    return figures.select(
        "player_name", "match_type", "matches", "innings_bowled", "total_balls",
        "total_runs", "total_wickets", "total_no_balls", "total_wides", "best_wickets",
        ratio("total_runs", "total_wickets").alias("bowling_avg"),
        ratio("total_runs", "total_balls", then_times=6).alias("economy"),
        ratio("total_balls", "total_wickets").alias("bowling_sr"),
        "five_wicket_hauls", "four_plus_wicket_hauls", "first_year", "last_year",
    )

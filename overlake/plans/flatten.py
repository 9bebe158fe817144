"""Nested match documents -> matches, innings, deliveries, players.

Input has match_id, match_type, year, meta, info, innings.  Each output is one lazy
projection with generators, so a scan reads only the leaves its output needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from overlake.functions import to_flag_sql, to_int_sql, to_list_sql
from overlake.schemas import SILVER

_REVISION = f"coalesce({to_int_sql('meta.revision')}, if(meta.revision IS NULL, 1, NULL))"


def _counter(path: str) -> str:
    """Missing counters are 0; present but unreadable ones stay NULL."""
    return f"if({path} IS NULL, 0, {to_int_sql(path)})"


def _joined(names: str) -> str:
    return f"nullif(array_join({names}, ', '), '')"


def _select(df: DataFrame, table: str, **columns: str) -> DataFrame:
    """Project to a silver table's columns, taking those not given by name."""
    return df.selectExpr(
        *[
            f"cast({columns.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in SILVER[table]
        ]
    )


def flatten_matches(docs: DataFrame) -> DataFrame:
    out = {
        "match_date": f"get({to_list_sql('info.dates')}, 0)",
        "team_1": f"get({to_list_sql('info.teams')}, 0)",
        "team_2": f"get({to_list_sql('info.teams')}, 1)",
        "player_of_match": _joined(to_list_sql("info.player_of_match")),
        "revision": _REVISION,
    }
    for leaf in ("season", "venue", "city", "gender", "team_type"):
        out[leaf] = f"info.{leaf}"
    for leaf in ("winner", "decision"):
        out[f"toss_{leaf}"] = f"info.toss.{leaf}"
    out["toss_uncontested"] = to_flag_sql("info.toss.uncontested")
    for leaf in ("winner", "result", "method", "eliminator", "bowl_out"):
        out[f"outcome_{leaf}"] = f"info.outcome.{leaf}"
    for leaf in ("runs", "wickets", "innings"):
        out[f"outcome_by_{leaf}"] = to_int_sql(f"info.outcome.by.{leaf}")
    for leaf in ("name", "group", "stage"):
        out[f"event_{leaf}"] = f"info.event.{leaf}"
    out["event_match_number"] = to_int_sql("info.event.match_number")
    for leaf in ("balls_per_over", "overs", "match_type_number"):
        out[leaf] = to_int_sql(f"info.{leaf}")
    return _select(docs, "matches", **out)


def _innings(docs: DataFrame) -> DataFrame:
    return docs.selectExpr(
        "match_id", "match_type", "year", f"{_REVISION} AS revision", "posexplode(innings) AS (pos, i)"
    ).withColumn("innings_number", F.expr("pos + 1"))


def flatten_innings(docs: DataFrame) -> DataFrame:
    return _select(
        _innings(docs),
        "innings",
        batting_team="i.team",
        declared=to_flag_sql("i.declared"),
        forfeited=to_flag_sql("i.forfeited"),
        super_over=to_flag_sql("i.super_over"),
        target_runs=to_int_sql("i.target.runs"),
        target_overs="try_variant_get(i.target.overs, '$', 'double')",
        penalty_runs_pre=to_int_sql("i.penalty_runs.pre"),
        penalty_runs_post=to_int_sql("i.penalty_runs.post"),
    )


def flatten_deliveries(docs: DataFrame) -> DataFrame:
    """One row per ball.  Only the first of several wickets on a ball gives its kind,
    player and fielders; ``wicket_count`` counts all of them."""
    overs = _innings(docs).withColumn("o", F.expr("explode(i.overs)"))
    balls = overs.selectExpr(
        "match_id",
        "match_type",
        "year",
        "revision",
        "innings_number",
        f"coalesce({to_int_sql('o.over')}, 0) AS over_number",
        "posexplode(o.deliveries) AS (ball, d)",
    )
    count = "if(d.wickets IS NULL, 0, size(d.wickets))"
    first = "get(d.wickets, 0)"
    fielders = f"filter({first}.fielders.name, n -> n IS NOT NULL AND n <> '')"
    out = {
        "ball_in_over": "ball + 1",
        "runs_non_boundary": to_flag_sql("d.runs.non_boundary"),
        "wicket_count": count,
        "is_wicket": f"{count} > 0",
        "wicket_kind": f"{first}.kind",
        "wicket_player_out": f"{first}.player_out",
        "wicket_fielders": _joined(fielders),
        "wicket_fielders_arr": fielders,
    }
    for leaf in ("batter", "bowler", "non_striker"):
        out[leaf] = f"d.{leaf}"
    for leaf in ("batter", "extras", "total"):
        out[f"runs_{leaf}"] = _counter(f"d.runs.{leaf}")
    for leaf in ("wides", "noballs", "byes", "legbyes", "penalty"):
        out[f"extras_{leaf}"] = _counter(f"d.extras.{leaf}")
    for leaf in ("by", "decision"):
        out[f"review_{leaf}"] = f"d.review.{leaf}"
    out["review_umpires_call"] = to_flag_sql("d.review.umpires_call")
    return _select(balls, "deliveries", **out)


def flatten_players(docs: DataFrame) -> DataFrame:
    listed = docs.selectExpr(
        "match_id",
        "match_type",
        "year",
        f"{_REVISION} AS revision",
        "info.registry.people AS people",
        "explode(info.players) AS (team, names)",
    )
    named = listed.withColumn("player_name", F.explode(F.expr(to_list_sql("names"))))
    return _select(named, "players", cricsheet_id="try_element_at(people, player_name)")


FLATTEN = {
    "matches": flatten_matches,
    "innings": flatten_innings,
    "deliveries": flatten_deliveries,
    "players": flatten_players,
}

# Parts of a document each table is built from.
PARTS = {
    "matches": ("meta", "info"),
    "innings": ("meta", "info", "innings"),
    "deliveries": ("meta", "info", "innings"),
    "players": ("meta", "info"),
}

"""What is loaded."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from overlake.operators.ranking import top_n
from overlake.plans.catalogue._shared import LEAGUE, down, league_matches, up


def matches_by_type(t) -> DataFrame:
    counted = t.match_results.groupBy("match_type").agg(F.count("*").alias("matches"))
    return counted.orderBy(down("matches"), up("match_type"))


def matches_by_year(t, last_n: int = 10, as_of: date | None = None) -> DataFrame:
    """Counts per year and type, from ``last_n`` years before ``as_of`` (today)."""
    this_year = F.year(F.current_date()) if as_of is None else F.lit(as_of.year)
    counted = (
        t.match_results.filter(F.col("year") >= this_year - last_n)
        .groupBy("year", "match_type")
        .agg(F.count("*").alias("matches"))
    )
    return counted.orderBy(down("year"), down("matches"), up("match_type"))


def recent_matches(t, n: int = 20) -> DataFrame:
    latest = top_n(t.match_results, [down("match_date"), down("match_id")], n)
    return latest.select(
        "match_id", "match_type", "match_date", "team_1", "team_2", "outcome_winner"
    )


def deliveries_by_type(t) -> DataFrame:
    counted = t.balls.groupBy("match_type").agg(F.count("*").alias("deliveries"))
    return counted.orderBy(down("deliveries"), up("match_type"))


def freshness(t, league: str = LEAGUE) -> DataFrame:
    """The league's last match."""
    last = top_n(league_matches(t, league), [down("match_date"), down("match_id")], 1)
    return last.select(
        "match_id",
        "match_date",
        "season",
        "team_1",
        "team_2",
        F.coalesce("event_stage", F.lit("League")).alias("stage"),
        F.coalesce("outcome_winner", F.lit("No result")).alias("result"),
    )

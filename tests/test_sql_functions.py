"""Every SQL table function against the DataFrame form of its query."""

import re
from datetime import date

import pytest

from overlake.plans.catalogue import audit, coverage, leaders, matches, player, season, team
from overlake.plans.catalogue.sql_functions import FUNCTIONS, register_functions
from overlake.workloads import match_tables
from tests.conftest import SF, rows

MODULES = (coverage, leaders, matches, player, team, season, audit)
# Arguments of the functions that need some, and of some that do not, as Python and as SQL.
NAMES = {"names": ["NATION_2", "NATION_1"]}
CALLS = {
    "matches_by_year": [{"last_n": 4, "as_of": date(2014, 6, 1)}],
    "recent_matches": [{}, {"n": 3}, {"n": 0}],
    "top_run_scorers": [{}, {"match_type": "t20", "min_inns": 10, "n": 7}],
    "top_strike_rates": [{"min_inns": 10}],
    "player_formats": [{"player": "NATION_2_P7"}],
    "average_trend": [{"player": "NATION_2_P7"}],
    "economy_by_over": [{}, {"strict": True}],
    "team_record": [{"team": "NATION_0"}],
    "head_to_head": [{"team_a": "NATION_2", "team_b": "NATION_3"}],
    "toss_advantage": [{}, {"match_types": ["odi"]}],
    "player_bowling_log": [{"player": "NATION_2_P7", "season": "2010"}],
    "batting_dominance": [{"season": "2010", "pct": 12.0}],
    "player_fielding": [{"player": "NATION_2_P10"}, {"player": "NATION_2_P1", "legacy_like": True}],
    "team_lowest_totals": [{**NAMES}, {**NAMES, "min_wkts": 3, "n": 4}],
}


def literal(value) -> str:
    if isinstance(value, list):
        return f"array({', '.join(map(literal, value))})"
    if isinstance(value, date):
        return f"DATE'{value}'"
    return repr(value) + ("D" if isinstance(value, float) else "")


def calls(name):
    if name in CALLS:
        return CALLS[name]
    wanted = [p.split()[0] for p in FUNCTIONS[name].parameters if "DEFAULT" not in p]
    values = {"player": "NATION_2_P7", "season": "2010", "players": ["NATION_2_P7", "NATION_1_P3"], **NAMES}
    return [{w: values[w] for w in wanted}]


def by_dataframe(t, name, arguments):
    margin = re.fullmatch("(won|lost)_by_(runs|wickets)", name)
    if margin:
        return team.team_margins(t, side=margin[1], unit=margin[2], **arguments)
    return next(getattr(m, name) for m in MODULES if hasattr(m, name))(t, **arguments)


def by_sql(spark, name, arguments):
    given = ", ".join(f"{k} => {literal(v)}" for k, v in arguments.items())
    return spark.sql(f"SELECT * FROM {name}({given})")


@pytest.fixture(scope="module")
def derived(spark):
    t = match_tables(spark, SF)
    register_functions(t)
    return t


@pytest.mark.parametrize("name", sorted(FUNCTIONS))
def test_function(spark, derived, name):
    for arguments in calls(name):
        ours, theirs = by_sql(spark, name, arguments), by_dataframe(derived, name, arguments)
        assert ours.columns == theirs.columns
        assert [f.dataType for f in ours.schema] == [f.dataType for f in theirs.schema]
        assert rows(ours) == rows(theirs)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, derived):
    for name in FUNCTIONS:
        text = plan(by_sql(spark, name, calls(name)[0]))
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text, name
    # Lists are cut before they are ranked, in one task or not.
    assert "TakeOrdered" in plan(by_sql(spark, "highest_scores", {"n": 5}))
    scan = plan(by_sql(spark, "player_batting", {"player": "NATION_2_P7"}))
    assert "EqualTo(player_name,NATION_2_P7)" in scan
    # Folders without matches of the league and season are found out while the query runs.
    pruned = plan(by_sql(spark, "batting_phases", {"season": "2010"}))
    assert "dynamicpruning" in pruned


def test_functions_join_and_nest(spark, derived):
    found = spark.sql(
        """SELECT s.season, s.won, b.avg_score FROM team_seasons(array('NATION_2')) s
           JOIN team_batting_seasons(array('NATION_2')) b USING (season) WHERE s.season >= '2010' ORDER BY s.season"""
    ).collect()
    assert found and all(r.season >= "2010" for r in found)
    # Arguments may be parameter markers, so nothing is pasted into SQL.
    named = spark.sql("SELECT * FROM player_formats(:who)", args={"who": "NATION_2_P7"})
    assert rows(named) == rows(leaders.player_formats(derived, "NATION_2_P7"))
    assert spark.sql("SELECT * FROM player_formats(:who)", args={"who": "x' OR '1' = '1"}).count() == 0


def test_hand_made_matches(spark, tables, derived):
    """Former names, ties, super overs, unknown players; then the other tables again."""
    register_functions(tables)
    try:
        for name, arguments in (
            ("player_batting", {"player": "F Chase"}),
            ("player_batting", {"player": "Nobody"}),
            ("player_bowling", {"player": "Nobody"}),
            ("player_bowling", {"player": "A Opener"}),
            ("player_fielding", {"player": "Al"}),
            ("player_fielding", {"player": "Al", "legacy_like": True}),
            ("season_results", {"names": ["Royal Challengers"], "season": "2012"}),
            ("season_summary", {"names": ["Royal Challengers"], "season": "2012"}),
            ("team_seasons", {"names": ["Delhi Capitals"]}),
            ("team_highest_totals", {"names": ["Delhi Capitals"]}),
            ("batting_phases", {"season": "2012"}),
            ("career_batting", {"players": ["A Opener", "S First"]}),
            ("freshness", {}),
        ):
            ours = by_sql(spark, name, arguments)
            assert rows(ours) == rows(by_dataframe(tables, name, arguments)), (name, arguments)
    finally:
        register_functions(derived)

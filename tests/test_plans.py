"""Physical plans: what must, and must not, be in them."""

import re

import pytest

from overlake.plans.catalogue import leaders, player, season, team
from overlake.workloads import match_tables, queries
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return match_tables(spark, SF)


def test_no_cross_joins_and_no_python(spark):
    for name, query in queries().items():
        if name in ("archive_members", "archive_ranges", "streamed_changes", "adopted_silver"):
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "Python" not in text and "InPandas" not in text, name


def test_player_query_prunes_and_pushes(t):
    text = plan(player.player_batting(t, "NATION_2_P7"))
    scan = text[text.index("FileScan"):]
    assert "EqualTo(player_name,NATION_2_P7)" in scan
    schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert "strike_rate" not in schema and "dismissal_kind" not in schema
    assert text.count("FileScan") == 1 and "participation" in scan


def test_fielding_reads_wickets_only(t):
    for query in (player.player_fielding, player.player_fielding_by_season):
        text = plan(query(t, "NATION_2_P1"))
        assert "/wickets" in text and "/ball_by_ball" not in text
    assert "/ball_by_ball" not in plan(leaders.wicket_kinds(t))
    assert "/ball_by_ball" not in plan(season.powerplay_impact(t, "NATION_2_P7", ("NATION_2",), "2010"))


def test_league_and_season_prune_folders(t):
    for df in (
        season.batting_concentration(t, "2010"),
        season.batting_phases(t, "2010"),
        team.team_batting_seasons(t, ("NATION_1",)),
        team.team_top_bowlers(t, ("NATION_1",)),
        player.player_fielding(t, "NATION_2_P1"),
    ):
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df)).group(1)
        assert "match_type" in filters and "year" in filters


def test_staged_deliveries_sort_by_key_only(spark, ingested):
    from overlake import MatchTables, Seeds, Silver

    text = plan(MatchTables(Silver.read(spark, ingested[0]), Seeds.standard(spark)).stg_deliveries)
    sorts = [s for s in re.findall(r"Sort \[(.*?)\], false", text) if "ball_in_over" in s]
    assert sorts and all(s.count(" ASC ") <= 5 for s in sorts)


def test_staging_sorts_no_share_of_a_file(spark, ingested):
    """A task reads a row group as a whole: what is sorted before the exchange grows with it and spills."""
    from overlake import MatchTables, Seeds, Silver

    t = MatchTables(Silver.read(spark, ingested[0]), Seeds.standard(spark))
    for table in (t.stg_deliveries, t.stg_players):
        text = plan(table)
        placed = text.index("REPARTITION_BY_COL")
        assert "SortAggregate" in text[:placed] and "SortAggregate" not in text[placed:]


def test_format_filter_prunes_partitions(t):
    text = plan(leaders.economy_by_over(t))
    assert re.search(r"PartitionFilters: \[[^\]]*match_type", text)


def test_season_queries_sum_before_joining(t):
    text = plan(season.phase_split_by_result(t, "2010"))
    # Below the join, the overs are already aggregated, and balls are not read at all.
    below = text[text.index("Join"):]
    assert below.index("HashAggregate") < below.index("over_number")
    assert "ball_by_ball" not in text


def test_top_lists_do_not_sort_everything(t):
    assert "TakeOrderedAndProject" in plan(team.team_top_batters(t, ["NATION_1"]))


def test_one_scan_of_the_balls_for_all_phases(t):
    assert plan(season.batting_phases(t, "2010")).count("FileScan") == 1


def test_odd_leaves_are_parsed_once_and_nothing_is_broadcast(spark):
    text = plan(queries()["flatten_odd_leaves"](spark, SF))
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text
    assert "inline(array(from_json" not in text

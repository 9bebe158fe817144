"""Staging, enrichment, innings and marts on the hand-made matches."""

import datetime as dt

from pyspark.sql import functions as F

from overlake.schemas import BALL_BY_BALL, BATTING_INNINGS, BOWLING_INNINGS, MATCH_RESULTS
from tests import documents as docs
from tests.conftest import rows


def test_processed_and_errors(ingested):
    _, first = ingested
    assert first.processed.count() == len(docs.ALL)
    assert [r.match_id for r in first.errors.collect()] == ["1009"]


def test_correction_replaces_the_match_as_a_whole(tables):
    balls = tables.stg_deliveries.filter("match_id = '1001' and innings_number = 1 and over_number = 0")
    found = rows(balls, "ball_in_over")
    # The removed fifth ball does not survive, the changed second one has its new value.
    assert [r["ball_in_over"] for r in found] == [1, 2, 3, 4]
    assert found[1]["runs_batter"] == 6
    assert tables.stg_matches.filter("match_id = '1001'").first().revision == 2
    assert tables.stg_players.filter("match_id = '1001'").count() == 7


def test_staging_types(tables):
    m = {r.match_id: r for r in tables.stg_matches.collect()}
    assert m["1001"].match_date == dt.date(2012, 4, 10) and m["1001"].year == 2012
    assert m["1008"].match_date is None and m["1008"].year is None
    assert m["1001"].toss_uncontested is False
    i = tables.stg_innings.filter("match_id = '1005' and innings_number = 2").first()
    assert (i.declared, i.forfeited, i.super_over, i.penalty_runs_pre) == (False, False, False, 0)


def test_ball_by_ball(tables):
    assert tables.ball_by_ball.columns == BALL_BY_BALL and len(BALL_BY_BALL) == 38
    b = tables.ball_by_ball
    first = b.filter("match_id = '1001' and innings_number = 1").first()
    assert (first.batting_team, first.bowling_team) == ("Delhi Capitals", docs.CSK)
    assert (first.venue, first.city) == ("Arun Jaitley Stadium", "Delhi")
    assert first.outcome_winner == docs.DD
    second = b.filter("match_id = '1001' and innings_number = 2").first()
    assert (second.batting_team, second.bowling_team) == (docs.CSK, "Delhi Capitals")
    assert b.filter("match_id = '1473495'").count() == 0


def test_match_results(tables):
    assert tables.match_results.columns == MATCH_RESULTS and len(MATCH_RESULTS) == 34
    m = {r.match_id: r for r in tables.match_results.collect()}
    assert (m["1001"].team_1, m["1001"].toss_winner, m["1001"].outcome_winner) == ("Delhi Capitals",) * 3
    assert (m["1001"].has_result, m["1001"].is_tie) == (True, None)
    assert (m["1003"].has_result, m["1003"].is_tie, m["1003"].is_draw) == (False, True, False)
    assert m["1004"].is_no_result is True and m["1005"].is_draw is True
    # Excluded matches stay here.
    assert "1473495" in m


def batting(tables, match_id, innings):
    found = tables.batting_innings.filter((F.col("match_id") == match_id) & (F.col("innings_number") == innings))
    return {r["player_name"]: r for r in rows(found)}


def test_batting_innings(tables):
    assert tables.batting_innings.columns == BATTING_INNINGS and len(BATTING_INNINGS) == 19
    first = batting(tables, "1001", 1)
    a, b = first["A Opener"], first["B Partner"]
    assert (a["runs"], a["balls_faced"], a["sixes"], a["fours"], a["not_out"]) == (7, 8, 1, 0, True)
    assert a["strike_rate"] == 87.5
    assert (b["runs"], b["balls_faced"], b["wides_faced"], b["dismissals"], b["dismissal_kind"]) == (0, 2, 1, 1, "caught")
    # After the correction this player only stands at the other end.
    d = first["D Late"]
    assert (d["balls_faced"], d["runs"], d["not_out"], d["strike_rate"]) == (0, 0, True, None)
    assert batting(tables, "1001", 2)["F Chase"]["fours"] == 0


def test_dismissed_without_facing(tables):
    found = batting(tables, "1002", 1)
    g, h = found["G Other"], found["H Last"]
    assert (g["balls_faced"], g["dismissals"], g["dismissal_kind"], g["not_out"]) == (0, 1, "run out", False)
    assert (h["balls_faced"], h["dismissals"], h["not_out"]) == (0, 0, True)


def test_retired_hurt_is_no_dismissal(tables):
    found = batting(tables, "1006", 1)
    assert found["F Chase"]["not_out"] is True and found["F Chase"]["dismissals"] == 0
    assert found["L Also"]["dismissal_kind"] == "retired out"
    # Of two wickets on a ball only the first is known by name.
    assert found["G Other"]["not_out"] is True


def test_partner_who_bats_elsewhere_in_the_match_adds_no_innings(tables):
    # X Bowl faces in innings 2 and only stands in innings 3.
    assert "X Bowl" in batting(tables, "1005", 2)
    assert "X Bowl" not in batting(tables, "1005", 3)


def test_bowling_innings(tables):
    assert tables.bowling_innings.columns == BOWLING_INNINGS and len(BOWLING_INNINGS) == 19
    k = rows(tables.bowling_innings.filter("match_id = '1006'"))[0]
    assert (k["wickets"], k["wickets_credited"], k["legal_deliveries"], k["overs_bowled"]) == (6, 1, 5, 0.5)
    c = rows(tables.bowling_innings.filter("match_id = '1001' and player_name = 'C Seamer'"))[0]
    assert (c["legal_deliveries"], c["total_deliveries"], c["wides"], c["runs_conceded"]) == (3, 4, 1, 8)
    assert c["economy"] == 16.0


def test_careers_leave_super_overs_out(tables):
    s = rows(tables.batting_career.filter("player_name = 'S First'"))[0]
    assert (s["matches"], s["innings"], s["total_runs"]) == (2, 2, 11)
    t = rows(tables.batting_career.filter("player_name = 'T Second'"))[0]
    assert (t["total_dismissals"], t["batting_avg"], t["batting_sr"]) == (0, None, None)
    k = rows(tables.bowling_career.filter("player_name = 'K Bowl' and match_type = 't20'"))[0]
    assert (k["total_wickets"], k["total_balls"], k["total_runs"], k["economy"]) == (1, 6, 3, 3.0)


def test_dim_players(tables):
    p = {r["player_name"]: r for r in rows(tables.dim_players)}
    assert p["A Opener"]["cricsheet_id"] == "id-a" and p["U Bat"]["cricsheet_id"] is None
    assert p["A Opener"]["teams"] == docs.DD and p["A Opener"]["total_matches"] == 1
    assert (p["U Bat"]["first_year"], p["U Bat"]["last_year"], p["U Bat"]["match_types"]) == (2013, 2013, "t20")


def test_sums_are_conserved(tables):
    balls = tables.ball_by_ball.agg(F.sum("runs_batter"), F.sum("runs_total"), F.sum("wicket_count")).first()
    bat = tables.batting_innings.agg(F.sum("runs"), F.sum("dismissals")).first()
    bowl = tables.bowling_innings.agg(F.sum("runs_conceded"), F.sum("wickets")).first()
    assert bat[0] == balls[0] and bowl[0] == balls[1] and bowl[1] == balls[2]
    assert bat[1] <= balls[2]


def test_stored_tables_can_be_loaded(spark, tables):
    from overlake import MatchTables

    tables.build()
    again = MatchTables.load(spark, tables.store)
    assert rows(again.match_results.select(*MATCH_RESULTS)) == rows(tables.match_results)
    assert again.batting.count() == tables.batting.count()


def test_fielders_from_joined_names(spark):
    from overlake.plans.staging import stage_deliveries
    from overlake.schemas import DELIVERIES

    row = {f.name: None for f in DELIVERIES} | {"match_id": "1", "innings_number": 1, "over_number": 0, "ball_in_over": 1}
    old = spark.createDataFrame([tuple({**row, "wicket_fielders": "Al, Al Keeper"}.values())], DELIVERIES)
    matches = spark.createDataFrame([("1", 1)], "match_id string, revision int")
    staged = stage_deliveries(old, matches).first()
    assert staged.wicket_fielders_arr == ["Al", "Al Keeper"] and staged.revision == 1

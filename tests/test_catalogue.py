"""Queries whose rare cases only the hand-made matches have."""

from datetime import date

from overlake.operators import reconcile
from overlake.plans.catalogue import audit, coverage, leaders, matches, player, season, team
from tests import documents as docs
from tests.conftest import rows

DC = "Delhi Capitals"


def test_coverage(tables):
    assert [tuple(r) for r in coverage.matches_by_type(tables).collect()] == [("t20", 6), ("test", 1), ("unknown", 1)]
    years = coverage.matches_by_year(tables, as_of=date(2022, 1, 1))
    assert [tuple(r) for r in years.collect()] == [(2025, "t20", 1), (2013, "t20", 2), (2012, "t20", 3), (2012, "test", 1)]
    assert [r.match_id for r in coverage.recent_matches(tables, 2).collect()] == ["1473495", "1006"]
    last = coverage.freshness(tables).first()
    assert (last.match_id, last.stage, last.result) == ("1473495", "League", DC)
    assert coverage.matches_by_year(tables).count() >= 1


def test_fielding_compares_whole_names(tables):
    al = player.player_fielding(tables, "Al").first()
    assert (al.catches, al.run_outs) == (0, 2)
    like = player.player_fielding(tables, "Al", legacy_like=True).first()
    assert (like.catches, like.run_outs) == (1, 2)
    keeper = player.player_fielding(tables, "Al Keeper").first()
    assert (keeper.catches, keeper.caught_and_bowled, keeper.run_outs) == (1, 0, 1)
    bowler = rows(player.player_fielding_by_season(tables, "K Bowl"))
    assert [(r["season"], r["caught_and_bowled"]) for r in bowler] == [("2012", 0), ("2013", 1)]


def test_player_batting_counts_retired_hurt_as_out(tables):
    # Faced in two regular innings, once retired hurt.
    f = player.player_batting(tables, "F Chase").first()
    assert (f.mat, f.inns, f.no, f.runs, f.hs, f.bf, f["4s"], f["6s"]) == (3, 3, 2, 11, 6 + 1, 6, 0, 1)
    log = player.player_innings_log(tables, "G Other").collect()
    assert [(r.runs, r.balls_faced, r.not_out, r.strike_rate) for r in log] == [
        (0, 0, True, None), (0, 0, False, None), (0, 0, True, None)]


def test_super_over_innings_do_not_count(tables):
    s = player.player_batting(tables, "S First").first()
    assert (s.inns, s.runs) == (2, 11)
    # Faces only in the super over, stands in the regular innings: not an innings.
    t = player.player_batting(tables, "T Second").first()
    assert (t.inns, t.mat) == (1, 1)


def test_unknown_player_gives_one_empty_row(tables):
    r = player.player_batting(tables, "Nobody").first()
    assert (r.mat, r.inns, r.runs, r.ave) == (0, 0, None, None)
    b = player.player_bowling(tables, "Nobody").first()
    assert (b.inns, b.mdns, b.bbi) == (0, 0, None)


def test_maiden_and_conceded_runs(tables):
    e = player.player_bowling(tables, "E Spin").first()
    assert (e.overs, e.mdns, e.runs, e.bbi) == ("1.0", 1, 0, "0/0")
    # Byes are not charged here, but are in the career table.
    a = player.player_bowling(tables, "A Opener").first()
    assert a.runs == 4
    career = tables.bowling_career.filter("player_name = 'A Opener'").first()
    assert career.total_runs == 8


def test_awards_and_margins(tables):
    found = {r["player"]: r["awards"] for r in rows(matches.player_of_match_awards(tables))}
    assert found == {"A Opener, B Partner": 1}
    assert [r.outcome_by_runs for r in matches.biggest_run_margins(tables).collect()] == [5, 5, 3]


def test_results_with_ties(tables):
    codes = [r.result for r in season.season_results(tables, ["Royal Challengers"], "2012").collect()]
    assert codes == ["W", "T"]
    nr = season.season_results(tables, [DC], "2013").collect()
    assert [r.result for r in nr] == ["NR"]
    r = season.season_summary(tables, ["Royal Challengers"], "2012").first()
    assert (r.played, r.won, r.lost, r.tied, r.nr, r.win_pct) == (2, 1, 0, 1, 0, 100.0)


def test_former_name_is_found_under_the_new_one(tables):
    assert team.team_seasons(tables, [docs.DD]).count() == 0
    found = {r["season"]: r["played"] for r in rows(team.team_seasons(tables, [DC]))}
    assert found == {"2012": 1, "2013": 1, "2025": 1}


def test_economy_by_over_divides_by_wide_runs(tables):
    first = leaders.economy_by_over(tables).first()
    strict = leaders.economy_by_over(tables, strict=True).first()
    assert first.balls == strict.balls and first.economy < strict.economy


def test_phase_split_agrees_with_win_loss(tables):
    split = {r["team"]: r for r in rows(season.phase_split_by_result(tables, "2012"))}
    swapped = {r["team"]: r for r in rows(season.phase_split_by_result(tables, "2012", swapped_bowling=True))}
    for name in split:
        wl = {r["result"]: r for r in rows(season.season_win_loss(tables, [name], "2012"))}
        assert split[name]["bowl_avg_W"] == wl.get("Won", {}).get("bowl_avg_conceded")
        assert split[name]["bat_avg_L"] == wl["Lost"]["bat_avg_score"]
        assert swapped[name]["bowl_avg_L"] == split[name]["bowl_avg_W"]


def test_powerplay_impact_always_has_two_rows(tables):
    none = season.powerplay_impact(tables, "Nobody", [DC], "2012").collect()
    assert [(r.scenario, r.matches, r.wins) for r in none] == [("Out in PP", 0, None), ("Survived PP", 0, None)]
    b = season.powerplay_impact(tables, "B Partner", [DC], "2012").collect()
    assert [(r.matches, r.wins, r.losses, r.win_pct) for r in b] == [(1, 1, 0, 100.0), (0, None, None, None)]


def test_shares(tables):
    s = season.batting_concentration(tables, "2012", k=1).filter(f"team = '{DC}'").first()
    assert (s.total_runs, s.top1_runs, s.top1_pct, s.top1_players) == (7, 7, 100.0, "A Opener (7)")
    d = season.batting_dominance(tables, "2012", pct=50.0)
    assert (DC, "A Opener") in {(r.team, r.batter) for r in d.collect()}
    b = season.season_batter_share(tables, [DC], "2012").collect()
    assert [(r.batter, r.pct_of_team_runs) for r in b] == [("A Opener", 100.0), ("B Partner", 0.0), ("D Late", 0.0)]


def test_reconciliation(tables):
    expected = [("A Opener", 7, 0, 0, "closed"), ("F Chase", 12, 0, 0, "closed"), ("S First", None, None, None, "")]
    found = {r["player"]: r for r in rows(audit.reconcile_batting(tables, expected))}
    assert found["A Opener"]["status"] == "OK" and found["F Chase"]["runs_diff"] == -1 and len(found) == 2
    assert audit.reconcile_batting(tables).count() == 0
    bowling = audit.reconcile_bowling(tables, [("K Bowl", 1, "closed")]).first()
    assert (bowling.status, bowling.wkts) == ("OK", 1)
    assert audit.career_batting(tables, ["A Opener"]).first().runs == 7
    assert callable(reconcile)


def test_standard_checks(tables):
    report = rows(audit.check_report(tables))
    assert sum(r["check"] == "not_null" for r in report) == 41
    assert sum(r["check"] == "unique" for r in report) == 5
    assert sum(r["check"] == "relationships" for r in report) == 3
    bad = {(r["check"], r["table"], r["column"]): r["failures"] for r in report if r["failures"]}
    # The unrouted match has neither a date nor a known format.
    assert bad == {("not_null", "stg_matches", "match_date"): 1, ("accepted_values", "stg_matches", "match_type"): 1}

"""The catalogue for SQL users: its queries as table functions with default arguments.

``register_functions(tables)`` makes them in the session::

    SELECT * FROM top_run_scorers(match_type => 't20', n => 5) ORDER BY total_runs DESC;
    SELECT * FROM team_seasons(array('Delhi Capitals', 'Delhi Daredevils')) ORDER BY season;

A function has the name, parameters and columns of the query in the sibling modules.  Its body
is SQL over views of the shared tables, and Catalyst folds the arguments into it: filters
reach the scan, ranked lists become a limit, and functions can be joined, filtered and nested
like tables.  League functions take the (match_type, year) folders of their matches from a semi join,
whose result prunes the scan while the query runs.

Rows have no order of their own; say ORDER BY.  ``n`` is a number, not NULL: NULL gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from overlake.functions import PHASES, overs_sql, ratio_sql, round_half_up_sql
from overlake.plans.catalogue import player, team
from overlake.plans.catalogue._shared import LEAGUE, RECORD, REGULAR
from overlake.plans.catalogue.season import PHASE_OVERS, batting_profile_sql, bowling_profile_sql

#: Views that the functions read, and the attribute of the tables behind each.
VIEWS = {
    "catalogue_matches": "match_results",
    "catalogue_balls": "balls",
    "catalogue_overs": "overs",
    "catalogue_wickets": "wickets",
    "catalogue_participation": "took_part",
    "catalogue_batting": "batting",
    "catalogue_bowling": "bowling",
    "catalogue_batting_career": "batting_career",
    "catalogue_bowling_career": "bowling_career",
}

_N = "n INT DEFAULT {}"
_LEAGUE = f"league STRING DEFAULT '{LEAGUE}'"
_TYPE = "match_type STRING DEFAULT '{}'"
_PLAYER, _NAMES, _SEASON = "player STRING", "names ARRAY<STRING>", "season STRING"


@dataclass(frozen=True)
class TableFunction:
    """A name, its parameters, and a body in which ``:x`` stands for parameter x."""

    name: str
    parameters: tuple[str, ...]
    body: str

    def statement(self) -> str:
        """The statement that makes the function for the session."""
        # Qualified, as columns of the same name would come first.
        body = re.sub(r":(\w+)", rf"{self.name}.\1", self.body)
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {self.name}({', '.join(self.parameters)}) RETURNS TABLE RETURN {body}"


def _list(figures: Mapping[str, str]) -> str:
    return ", ".join(f"{sql} AS `{name}`" for name, sql in figures.items())


def _top(columns: str, rows: str, order: str, n: str = ":n") -> str:
    """The first rows of a query in an order that has no ties."""
    ranked = f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({rows})"
    return f"SELECT {columns} FROM ({ranked}) WHERE place <= {n}"


def _down(name: str) -> str:
    return f"{name} DESC NULLS LAST"


def _up(name: str) -> str:
    return f"{name} ASC NULLS LAST"


def _order(first: str, *others: str) -> str:
    return ", ".join([first, *map(_up, others)])


# rows ------------------------------------------------------------------------


def _in_league(season: bool) -> str:
    return "event_name ILIKE :league" + (" AND season = :season" if season else "")


def _league_matches(columns: str = "*", season: bool = False, names: bool = False) -> str:
    side = " AND (array_contains(:names, team_1) OR array_contains(:names, team_2))" if names else ""
    return f"SELECT {columns} FROM catalogue_matches WHERE {_in_league(season)}{side}"


_INNINGS = ("catalogue_batting", "catalogue_bowling")


def _league_rows(view: str, columns: str = "*", season: bool = False, where: str = "true") -> str:
    """Rows of the league, super overs left out, from the folders that hold its matches alone."""
    folders = _league_matches("coalesce(match_type, '') AS folder, coalesce(year, -1) AS in_year", season)
    regular = f"innings_number IN {REGULAR}" + (" AND NOT super_over" if view in _INNINGS else "")
    return (
        f"SELECT {columns} FROM {view} LEFT SEMI JOIN ({folders}) "
        "ON coalesce(match_type, '') = folder AND coalesce(year, -1) = in_year "
        f"WHERE {_in_league(season)} AND {regular} AND {where}"
    )


_OPPONENT = "CASE WHEN array_contains(:names, team_1) THEN team_2 ELSE team_1 END"


def _outcomes(season: bool = False) -> str:
    """Matches of the named team, with ``won`` and ``lost`` as it sees them."""
    own = "array_contains(:names, outcome_winner)"
    columns = (
        f"*, {own} AS won, has_result AND NOT {own} AS lost, {_OPPONENT} AS opponent, "
        "CASE WHEN array_contains(:names, team_1) THEN team_1 ELSE team_2 END AS own_name, "
        "array_contains(:names, toss_winner) AS called"
    )
    return _league_matches(columns, season, names=True)


_BATTING_LOG = (
    "SELECT match_id, innings_number, match_date, season, batting_team, bowling_team, runs, non_wides AS balls, "
    "fours, sixes, balls_faced AS faced, cast(out_any AS int) AS dismissed FROM catalogue_participation "
    f"WHERE player_name = :player AND event_name ILIKE :league AND innings_number IN {REGULAR} "
    "AND (balls_faced > 0 OR out_any OR NOT batted)"
)


def _bowling_log(season: bool = False) -> str:
    return (
        "SELECT match_id, innings_number, match_date, season, bowling_team, total_deliveries AS deliveries, "
        "legal_deliveries AS balls, charged_runs AS runs, wickets_credited AS wkts, wides, no_balls AS nb, "
        f"maidens AS mdns FROM catalogue_bowling WHERE player_name = :player AND {_in_league(season)} "
        f"AND innings_number IN {REGULAR}"
    )


def _with_sides(spells: str) -> str:
    return (
        "SELECT s.*, CASE WHEN m.team_1 = s.bowling_team THEN m.team_2 ELSE m.team_1 END AS vs "
        f"FROM ({spells}) s JOIN catalogue_matches m ON s.match_id = m.match_id"
    )


def _innings_totals(side: str, **measures: str) -> str:
    sums = _list({name: f"sum({m})" for name, m in measures.items()})
    rows = _league_rows("catalogue_overs", where=f"array_contains(:names, {side})")
    return f"SELECT match_id, innings_number, match_date, season, {sums} FROM ({rows}) GROUP BY ALL"


_MADE = _innings_totals("batting_team", team_total="runs", wickets_lost="team_wkts", fours="fours", sixes="sixes")
_CONCEDED = _innings_totals("bowling_team", runs_conceded="runs", legal="legal", wkts_taken="credited")


def _scorecard(totals: str, order: str, runs: str, wickets: str, score: str) -> str:
    best = _top("*", totals, _order(order, "match_id", "innings_number"))
    return (
        f"SELECT b.season, b.match_date, m.vs, m.event_stage, concat(b.{runs}, '/', b.{wickets}) AS {score}, b.{runs} "
        f"FROM ({best}) b JOIN (SELECT match_id, event_stage, {_OPPONENT} AS vs FROM catalogue_matches) m ON b.match_id = m.match_id"
    )


# functions -------------------------------------------------------------------


def _coverage() -> list[TableFunction]:
    latest = f"{_down('match_date')}, {_down('match_id')}"
    return [
        TableFunction("matches_by_type", (), "SELECT match_type, count(*) AS matches FROM catalogue_matches GROUP BY match_type"),
        TableFunction(
            "matches_by_year", ("last_n INT DEFAULT 10", "as_of DATE DEFAULT current_date()"),
            "SELECT year, match_type, count(*) AS matches FROM catalogue_matches "
            "WHERE year >= year(:as_of) - :last_n GROUP BY year, match_type",
        ),
        TableFunction(
            "recent_matches", (_N.format(20),),
            _top("match_id, match_type, match_date, team_1, team_2, outcome_winner", "SELECT * FROM catalogue_matches", latest),
        ),
        TableFunction("deliveries_by_type", (), "SELECT match_type, count(*) AS deliveries FROM catalogue_balls GROUP BY match_type"),
        TableFunction(
            "freshness", (_LEAGUE,),
            _top(
                "match_id, match_date, season, team_1, team_2, coalesce(event_stage, 'League') AS stage, "
                "coalesce(outcome_winner, 'No result') AS result",
                _league_matches(), latest, "1",
            ),
        ),
    ]


def _career(name: str, view: str, match_type: str, order: str, columns: str, least: str | None = None) -> TableFunction:
    """A list by career; ``least`` is a column that must reach a number."""
    where = "match_type = :match_type" + (f" AND {least} >= :min_inns" if least else "")
    parameters = (_TYPE.format(match_type), *([f"min_inns INT DEFAULT {30 if name == 'top_strike_rates' else 50}"] if least else []), _N.format(20))
    return TableFunction(name, parameters, _top(columns, f"SELECT * FROM {view} WHERE {where}", _order(order, "player_name")))


def _leaders() -> list[TableFunction]:
    bat, bowl = "catalogue_batting_career", "catalogue_bowling_career"
    innings = "SELECT * FROM catalogue_batting WHERE match_type = :match_type"
    unique = ("match_id", "innings_number", "player_name")
    of = "player_name, batting_team, bowling_team, match_date"
    return [
        _career(
            "top_run_scorers", bat, "odi", _down("total_runs"),
            "player_name, matches, innings, total_runs, highest_score, batting_avg, batting_sr, centuries, fifties", "innings",
        ),
        _career(
            "top_strike_rates", bat, "t20", _down("batting_sr"),
            "player_name, innings, total_runs, batting_avg, batting_sr, total_sixes, total_fours", "innings",
        ),
        _career(
            "most_centuries", bat, "test", _down("centuries"),
            "player_name, matches, innings, centuries, fifties, total_runs, batting_avg, first_year, last_year",
        ),
        TableFunction(
            "player_formats", (_PLAYER,),
            "SELECT player_name, match_type, matches, innings, total_runs, batting_avg, batting_sr, centuries, fifties "
            f"FROM {bat} WHERE player_name = :player",
        ),
        TableFunction(
            "highest_scores", (_TYPE.format("odi"), _N.format(20)),
            _top(f"{of}, runs, balls_faced, strike_rate, fours, sixes, not_out", innings, _order(_down("runs"), *unique)),
        ),
        TableFunction(
            "most_sixes_innings", (_TYPE.format("t20"), _N.format(20)),
            _top(f"{of}, runs, sixes, fours, balls_faced", innings, _order(_down("sixes"), *unique)),
        ),
        TableFunction(
            "average_trend", (_PLAYER, _TYPE.format("odi")),
            f"SELECT year, count(DISTINCT match_id) AS matches, sum(runs) AS runs, {ratio_sql('sum(runs)', 'sum(dismissals)')} AS avg "
            "FROM catalogue_batting WHERE player_name = :player AND match_type = :match_type AND NOT super_over GROUP BY year",
        ),
        _career(
            "top_wicket_takers", bowl, "odi", _down("total_wickets"),
            "player_name, matches, innings_bowled, total_wickets, bowling_avg, economy, bowling_sr, five_wicket_hauls", "innings_bowled",
        ),
        _career(
            "best_economy", bowl, "t20", _up("economy"),
            "player_name, innings_bowled, total_wickets, economy, bowling_avg, bowling_sr", "innings_bowled",
        ),
        _career(
            "most_five_wicket_hauls", bowl, "test", _down("five_wicket_hauls"),
            "player_name, matches, total_wickets, five_wicket_hauls, bowling_avg, economy, first_year, last_year",
        ),
        TableFunction(
            "best_bowling_innings", (_N.format(20),),
            _top(
                "player_name, bowling_team, batting_team, match_date, match_type, wickets_credited, runs_conceded, legal_deliveries",
                "SELECT * FROM catalogue_bowling WHERE NOT super_over",
                _order(_down("wickets_credited"), "runs_conceded", *unique),
            ),
        ),
        TableFunction("wicket_kinds", (), "SELECT wicket_kind, count(*) AS wickets FROM catalogue_wickets GROUP BY wicket_kind"),
        TableFunction(
            "economy_by_over", (_TYPE.format("t20"), "strict BOOLEAN DEFAULT false"),
            f"SELECT over_number, balls, runs, {ratio_sql('runs', 'CASE WHEN :strict THEN legal ELSE balls - wide_runs END', 2, times=6)} AS economy "
            "FROM (SELECT over_number, sum(deliveries) AS balls, sum(runs) AS runs, sum(legal) AS legal, sum(wide_runs) AS wide_runs "
            f"FROM catalogue_overs WHERE match_type = :match_type AND innings_number IN {REGULAR} GROUP BY over_number)",
        ),
    ]


def _matches() -> list[TableFunction]:
    sides = (
        "inline(array(named_struct('listed', 1, 'team', team_1, 'other', team_2), "
        "named_struct('listed', 2, 'team', team_2, 'other', team_1)))"
    )
    wins, kept = "sum(cast(outcome_winner = team AS int))", "sum(cast(toss_winner = outcome_winner AS int))"
    record = {
        "played": "count(*)",
        "won": wins,
        "lost": "sum(cast(outcome_winner = other AS int))",
        "tied": "sum(cast(is_tie AS int))",
        "no_result": "sum(cast(NOT has_result AS int))",
        "win_pct": ratio_sql(wins, "sum(cast(has_result AS int))", 1, times=100),
    }
    return [
        TableFunction(
            "team_record", ("team STRING", _TYPE.format("odi")),
            f"SELECT team, {', '.join(record)} FROM (SELECT listed, team, {_list(record)} FROM "
            f"(SELECT outcome_winner, is_tie, has_result, {sides} FROM catalogue_matches "
            "WHERE match_type = :match_type AND (team_1 = :team OR team_2 = :team)) WHERE team = :team GROUP BY listed, team)",
        ),
        TableFunction(
            "head_to_head", ("team_a STRING", "team_b STRING"),
            "SELECT match_type, count(*) AS played, sum(a) AS team_a_wins, sum(b) AS team_b_wins, sum(cast(is_tie AS int)) AS ties FROM "
            "(SELECT match_type, is_tie, cast(outcome_winner = :team_a AS int) AS a, cast(outcome_winner = :team_b AS int) AS b "
            "FROM catalogue_matches WHERE has_result AND (team_1 = :team_a AND team_2 = :team_b OR team_1 = :team_b AND team_2 = :team_a)) "
            "GROUP BY match_type",
        ),
        TableFunction(
            "toss_advantage", ("match_types ARRAY<STRING> DEFAULT array('t20', 'odi', 'test')",),
            f"SELECT match_type, toss_decision, count(*) AS matches, {kept} AS toss_winner_won, {ratio_sql(kept, 'count(*)', 1, times=100)} AS toss_win_pct "
            "FROM catalogue_matches WHERE has_result AND array_contains(:match_types, match_type) GROUP BY match_type, toss_decision",
        ),
        TableFunction(
            "biggest_run_margins", (_TYPE.format("t20"), _N.format(20)),
            _top(
                "team_1, team_2, outcome_winner, outcome_by_runs, match_date, venue",
                "SELECT * FROM catalogue_matches WHERE match_type = :match_type AND outcome_by_runs IS NOT NULL",
                _order(_down("outcome_by_runs"), "match_id"),
            ),
        ),
        TableFunction(
            "player_of_match_awards", (_N.format(20),),
            _top(
                "player, match_type, awards",
                "SELECT player_of_match AS player, match_type, count(*) AS awards FROM catalogue_matches "
                "WHERE player_of_match IS NOT NULL GROUP BY player_of_match, match_type",
                _order(_down("awards"), "player", "match_type"),
            ),
        ),
        TableFunction(
            "venue_counts", (_N.format(30),),
            _top(
                "venue, city, match_type, matches, first_match, last_match",
                "SELECT venue, city, match_type, count(*) AS matches, min(match_date) AS first_match, max(match_date) AS last_match "
                "FROM catalogue_matches GROUP BY venue, city, match_type",
                _order(_down("matches"), "venue", "city", "match_type"),
            ),
        ),
    ]


def _player() -> list[TableFunction]:
    who = (_PLAYER, _LEAGUE)
    top = (_PLAYER, _N.format(20), _LEAGUE)
    season = (_PLAYER, "season STRING DEFAULT '2025'", _LEAGUE)
    long = {
        "matches": "mat", "innings": "inns", "total_runs": "runs", "highest_score": "hs", "batting_avg": "ave", "strike_rate": "sr",
        "centuries": "`100`", "fifties": "`50`", "total_fours": "`4s`", "total_sixes": "`6s`",
    }
    career = f"SELECT {_list(player.SUMMARY)} FROM ({_BATTING_LOG})"
    figures = {**player.FIGURES, "mdns": "coalesce(sum(mdns), 0)"}
    shown = "mat, inns, overs, balls, mdns, runs, wkts, bbi, ave, econ, sr, `4w`, `5w`"
    caught = {name: f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)" for name, cond in player.CATCHES.items()}
    fielded = (
        "season, wicket_kind, CASE WHEN :legacy_like THEN contains(wicket_fielders, :player) "
        "ELSE array_contains(wicket_fielders_arr, :player) END AS fielded, bowler = :player AS bowled"
    )
    wickets = _league_rows("catalogue_wickets", fielded)
    like = (_PLAYER, _LEAGUE, "legacy_like BOOLEAN DEFAULT false")
    return [
        TableFunction("player_batting", who, career),
        TableFunction("player_batting_career", who, f"SELECT :player AS player_name, {_list(long)} FROM ({career})"),
        TableFunction(
            "player_batting_by_season", who,
            f"SELECT season, mode(batting_team, true) AS team, {_list(player.SUMMARY)} FROM ({_BATTING_LOG}) GROUP BY season",
        ),
        TableFunction("player_batting_trend", who, f"SELECT season, {_list(player.TREND)} FROM ({_BATTING_LOG}) GROUP BY season"),
        TableFunction(
            "player_top_innings", top,
            _top(
                f"season, match_date, batting_team, bowling_team AS vs, runs, dismissed = 0 AS not_out, balls, {player.RATE} AS sr, fours, sixes",
                f"SELECT * FROM ({_BATTING_LOG}) WHERE faced > 0", _order(_down("runs"), "match_id", "innings_number"),
            ),
        ),
        TableFunction(
            "player_innings_log", who,
            "SELECT season, match_date, batting_team, bowling_team AS vs, runs, balls AS balls_faced, "
            f"{player.RATE} AS strike_rate, fours, sixes, dismissed = 0 AS not_out FROM ({_BATTING_LOG})",
        ),
        TableFunction(
            "player_dismissals_by_season", who,
            f"SELECT season, {_list(player.DISMISSALS)} FROM ({_BATTING_LOG}) GROUP BY season",
        ),
        TableFunction("player_bowling", who, f"SELECT {shown} FROM (SELECT {_list(figures)} FROM ({_bowling_log()}))"),
        TableFunction(
            "player_bowling_by_season", who,
            f"SELECT season, {_list(player.FIGURES)} FROM ({_bowling_log()}) GROUP BY season",
        ),
        TableFunction(
            "player_best_bowling", top,
            _top(
                f"season, match_date, bowling_team, vs, wkts, runs, balls, {overs_sql('balls')} AS overs",
                _with_sides(_bowling_log()), _order(_down("wkts"), "runs", "match_id", "innings_number"),
            ),
        ),
        TableFunction(
            "player_bowling_log", season,
            f"SELECT match_date, vs, {overs_sql('balls')} AS overs, balls, runs, wkts, wides, nb, "
            f"{ratio_sql('runs', 'balls', times=6)} AS econ, match_id FROM ({_with_sides(_bowling_log(season=True))})",
        ),
        TableFunction("player_fielding", like, f"SELECT {_list(caught)} FROM ({wickets})"),
        TableFunction("player_fielding_by_season", like, f"SELECT season, {_list(caught)} FROM ({wickets}) GROUP BY season"),
    ]


def _team() -> list[TableFunction]:
    who, top = (_NAMES, _LEAGUE), (_NAMES, _N.format(10), _LEAGUE)
    matches, record = _outcomes(), _list(RECORD)
    wins, called = "sum(CASE WHEN won THEN 1 ELSE 0 END)", "sum(CASE WHEN called THEN 1 ELSE 0 END)"
    toss = {
        "matches": "count(*)",
        "toss_won": called,
        "toss_win_pct": ratio_sql(called, "count(*)", 1, times=100),
        "chose_bat": "sum(CASE WHEN called AND toss_decision = 'bat' THEN 1 ELSE 0 END)",
        "chose_field": "sum(CASE WHEN called AND toss_decision = 'field' THEN 1 ELSE 0 END)",
        "won_toss_won_match": "sum(CASE WHEN called AND won THEN 1 ELSE 0 END)",
        "lost_toss_won_match": "sum(CASE WHEN NOT called AND won THEN 1 ELSE 0 END)",
    }
    decision = {"times_chosen": "count(*)", "won": wins, "win_pct": ratio_sql(wins, "count(*)", 1, times=100)}
    batters = _league_rows("catalogue_batting", where="array_contains(:names, batting_team)")
    bowlers = _league_rows("catalogue_bowling", where="array_contains(:names, bowling_team)")
    margins = [
        TableFunction(
            f"{side}_by_{unit}", top,
            _top(
                f"season, match_date, opponent AS vs, event_stage, outcome_by_{unit} AS {side}_by_{unit}",
                f"SELECT * FROM ({matches}) WHERE {side} AND outcome_by_{unit} IS NOT NULL",
                _order(_down(f"outcome_by_{unit}"), "match_id"),
            ),
        )
        for side in ("won", "lost")
        for unit in ("runs", "wickets")
    ]
    return [
        TableFunction("team_seasons", who, f"SELECT season, mode(own_name, true) AS team, {record} FROM ({matches}) GROUP BY season"),
        TableFunction(
            "team_by_stage", who,
            f"SELECT stage, {record} FROM (SELECT *, coalesce(event_stage, 'League') AS stage FROM ({matches})) GROUP BY stage",
        ),
        TableFunction("team_vs_opponents", who, f"SELECT opponent, {record} FROM ({matches}) GROUP BY opponent"),
        TableFunction("team_toss", who, f"SELECT {_list(toss)} FROM ({matches}) WHERE has_result"),
        TableFunction(
            "team_toss_decision", who,
            f"SELECT toss_decision AS decision, {_list(decision)} FROM ({matches}) WHERE has_result AND called GROUP BY toss_decision",
        ),
        TableFunction("team_batting_seasons", who, f"SELECT season, {_list(team.BATTING_SEASON)} FROM ({_MADE}) GROUP BY season"),
        TableFunction("team_bowling_seasons", who, f"SELECT season, {_list(team.BOWLING_SEASON)} FROM ({_CONCEDED}) GROUP BY season"),
        TableFunction("team_highest_totals", top, _scorecard(_MADE, _down("team_total"), "team_total", "wickets_lost", "score")),
        TableFunction(
            "team_lowest_totals", (_NAMES, _N.format(10), "min_wkts INT DEFAULT 8", _LEAGUE),
            _scorecard(
                f"SELECT * FROM ({_MADE}) WHERE wickets_lost >= :min_wkts", _up("team_total"), "team_total", "wickets_lost", "score",
            ),
        ),
        TableFunction(
            "team_lowest_conceded", top, _scorecard(_CONCEDED, _up("runs_conceded"), "runs_conceded", "wkts_taken", "score_conceded"),
        ),
        TableFunction(
            "team_top_batters", (_NAMES, _N.format(20), _LEAGUE),
            _top("* EXCEPT (place)", f"SELECT player_name AS batter, {_list(team.BATTING)} FROM ({batters}) GROUP BY player_name",
                 _order(_down("runs"), "batter")),
        ),
        TableFunction(
            "team_top_bowlers", (_NAMES, _N.format(20), _LEAGUE),
            _top("* EXCEPT (place)",
                 f"SELECT player_name AS bowler, {_list(team.bowling_figures('4w+', '5w+'))} FROM ({bowlers}) GROUP BY player_name",
                 _order(_down("wkts"), "bowler")),
        ),
        *margins,
    ]


def _phases(side: str, runs: str, rate: str) -> str:
    measures = ("runs", "wkts", "legal", "non_wides", "fours", "sixes")
    cells = {
        f"{p}_{m}": f"sum(CASE WHEN over_number BETWEEN {lo} AND {hi} THEN {m} ELSE 0 END)"
        for p, (lo, hi, *_) in PHASES.items()
        for m in measures
    }
    by_match = (
        f"SELECT {side} AS team, match_id, {_list(cells)} FROM ({_league_rows('catalogue_overs', season=True, where=PHASE_OVERS)}) "
        f"GROUP BY {side}, match_id"
    )
    sums = f"SELECT team, count(*) AS mat, {_list({c: f'sum({c})' for c in cells})} FROM ({by_match}) GROUP BY team"
    out: dict[str, str] = {}
    for p in PHASES:
        out[f"{p}_{runs}"] = ratio_sql(f"{p}_runs", "mat", 1)
        out[f"{p}_wkts"] = ratio_sql(f"{p}_wkts", "mat", 2)
        out[f"{p}_{rate}"] = ratio_sql(f"{p}_runs", f"{p}_legal", 2, times=6)
        out[f"{p}_boundary_pct"] = ratio_sql(f"({p}_fours + {p}_sixes)", f"{p}_non_wides", 1, times=100)
    return f"SELECT team, {_list(out)} FROM ({sums})"


def _profile(side: str, measures: tuple[str, ...], columns: str, figures: Mapping[str, str]) -> str:
    sums = _list({m: f"sum({m})" for m in measures})
    by_match = (
        f"SELECT {side} AS team, match_id, {sums} FROM ({_league_rows('catalogue_overs', season=True)}) GROUP BY {side}, match_id"
    )
    return f"SELECT {columns}, {_list(figures)} FROM (SELECT team, count(*) AS mat, {sums} FROM ({by_match}) GROUP BY team)"


def _season() -> list[TableFunction]:
    one, all_teams = (_NAMES, _SEASON, _LEAGUE), (_SEASON, _LEAGUE)
    matches = _outcomes(season=True)
    code = "CASE WHEN won THEN 'W' WHEN is_no_result THEN 'NR' WHEN is_tie THEN 'T' ELSE 'L' END"
    batters = _league_rows("catalogue_batting", season=True)
    runs = f"SELECT batting_team AS team, player_name AS batter, sum(runs) AS runs FROM ({batters}) GROUP BY batting_team, player_name"
    share = ratio_sql("runs", "total_runs", None, times=100)
    return [
        TableFunction(
            "season_results", one,
            f"SELECT match_date, opponent AS vs, coalesce(event_stage, 'League') AS stage, {code} AS result, "
            f"outcome_by_runs AS by_runs, outcome_by_wickets AS by_wkts, outcome_method FROM ({matches})",
        ),
        TableFunction("season_summary", one, f"SELECT {_list(RECORD)} FROM ({matches})"),
        TableFunction(
            "batting_dominance", (_SEASON, "pct DOUBLE DEFAULT 25.0D", _LEAGUE),
            f"SELECT team, batter, runs, total_runs, {round_half_up_sql(share, 1)} AS pct_of_team_runs FROM "
            f"(SELECT r.team, r.batter, r.runs, s.total_runs FROM ({runs}) r "
            f"JOIN (SELECT team, sum(runs) AS total_runs FROM ({runs}) GROUP BY team) s ON r.team = s.team) WHERE {share} >= :pct",
        ),
        TableFunction(
            "batting_profile", all_teams,
            _profile("batting_team", ("bat_runs", "non_wides", "fours", "sixes", "dots"), "team, mat", batting_profile_sql("balls_per_4", "balls_per_6")),
        ),
        TableFunction(
            "bowling_profile", all_teams,
            _profile(
                "bowling_team", ("legal", "wkts", "runs", "dots", "non_wides", "wide_runs", "no_ball_runs"), "team",
                bowling_profile_sql("economy"),
            ),
        ),
        TableFunction("batting_phases", all_teams, _phases("batting_team", "runs", "rr")),
        TableFunction("bowling_phases", all_teams, _phases("bowling_team", "conceded", "econ")),
        TableFunction(
            "season_batters", one,
            f"SELECT player_name AS batter, {_list(team.BATTING)} FROM "
            f"({_league_rows('catalogue_batting', season=True, where='array_contains(:names, batting_team)')}) GROUP BY player_name",
        ),
        TableFunction(
            "season_bowlers", one,
            f"SELECT player_name AS bowler, {_list(team.bowling_figures('4w+'))} FROM "
            f"({_league_rows('catalogue_bowling', season=True, where='array_contains(:names, bowling_team)')}) GROUP BY player_name",
        ),
    ]


def _audit() -> list[TableFunction]:
    who = ("players ARRAY<STRING>", _LEAGUE)
    batting = _league_rows("catalogue_batting", where="array_contains(:players, player_name)")
    bowling = _league_rows("catalogue_bowling", where="array_contains(:players, player_name)")
    renamed = {name.rstrip("s") if name in ("100s", "50s") else name: sql for name, sql in team.BATTING.items()}
    ducks = "sum(CASE WHEN runs = 0 AND NOT not_out THEN 1 ELSE 0 END)"
    order = ("mat", "inns", "no", "runs", "hs", "avg", "bf", "sr", "100", "50")
    figures = {name: renamed[name] for name in order} | {"ducks": ducks} | {name: renamed[name] for name in ("4s", "6s")}
    return [
        TableFunction("career_batting", who, f"SELECT player_name AS player, {_list(figures)} FROM ({batting}) GROUP BY player_name"),
        TableFunction(
            "career_bowling", who,
            f"SELECT player_name AS player, {_list(team.bowling_figures('4w', '5w'))} FROM ({bowling}) GROUP BY player_name",
        ),
    ]


FUNCTIONS: dict[str, TableFunction] = {
    f.name: f for family in (_coverage, _leaders, _matches, _player, _team, _season, _audit) for f in family()
}


def register_functions(tables, *names: str) -> list[str]:
    """Makes the named functions, or all, in the session over ``tables``; a later call puts others in their place."""
    spark = tables.match_results.sparkSession
    for view, attribute in VIEWS.items():
        getattr(tables, attribute).createOrReplaceTempView(view)
    made = names or tuple(FUNCTIONS)
    for name in made:
        spark.sql(FUNCTIONS[name].statement())
    return list(made)

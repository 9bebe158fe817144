"""One statement per registered query."""

from __future__ import annotations

from oracle.base import CREDITED, LEGAL, with_tables

IPL = "event_name ILIKE '%indian premier league%'"
MAIN = "innings_number < 3"
P = "'NATION_2_P7'"
P1 = "'NATION_2_P1'"
KEEPER = "'NATION_2_P10'"
TS = "('NATION_1', 'NATION_16')"
T1 = "('NATION_2')"
YEAR = "season = '2010'"
VS = "CASE WHEN team_1 IN {n} THEN team_2 ELSE team_1 END AS vs"
DAY = "match_date::VARCHAR AS match_date"
WIDE_FREE = "count(*) FILTER (WHERE extras_wides = 0)"
LEGALS = f"count(*) FILTER (WHERE {LEGAL})"
FOURS = "count(*) FILTER (WHERE runs_batter = 4 AND NOT runs_non_boundary)"
SIXES = "count(*) FILTER (WHERE runs_batter = 6 AND NOT runs_non_boundary)"
DOTS = "count(*) FILTER (WHERE runs_batter = 0 AND extras_wides = 0)"
HITS = "count(*) FILTER (WHERE runs_batter IN (4, 6) AND NOT runs_non_boundary)"
PHASE = {"pp": "over_number <= 5", "mid": "over_number BETWEEN 6 AND 14", "death": "over_number BETWEEN 15 AND 19"}


def big(x: str) -> str:
    return f"sum({x})::BIGINT"


def per(num: str, den: str, places: int = 2, times: str = "1.0") -> str:
    return f"round(({num}) * {times} / nullif({den}, 0), {places})"


def overs(balls: str) -> str:
    return f"({balls}) // 6 || '.' || ({balls}) % 6"


def record(names: str) -> str:
    return f"""count(*) AS played,
      count(*) FILTER (WHERE outcome_winner IN {names}) AS won,
      count(*) FILTER (WHERE has_result AND outcome_winner NOT IN {names}) AS lost,
      sum(is_tie::INT)::BIGINT AS tied, sum(is_no_result::INT)::BIGINT AS nr,
      {per(f"count(*) FILTER (WHERE outcome_winner IN {names})", "count(*) FILTER (WHERE has_result)", 1, "100.0")} AS win_pct"""


def played(names: str) -> str:
    return f"({IPL}) AND (team_1 IN {names} OR team_2 IN {names})"


def code(names: str) -> str:
    return f"""CASE WHEN outcome_winner IN {names} THEN 'W' WHEN outcome_result = 'no result' THEN 'NR'
      WHEN outcome_result = 'tie' THEN 'T' ELSE 'L' END AS result"""


BAT_SUMMARY = f"""count(DISTINCT match_id) AS mat, count(*) AS inns, count(*) FILTER (WHERE not_out) AS no,
  {big('runs')} AS runs, max(runs) AS hs, {per('sum(runs)', 'sum(dismissals)')} AS avg,
  {big('balls_faced')} AS bf, {per('sum(runs)', 'sum(balls_faced)', 2, '100.0')} AS sr,
  count(*) FILTER (WHERE runs BETWEEN 50 AND 99) AS "50s", count(*) FILTER (WHERE runs > 99) AS "100s",
  {big('fours')} AS "4s", {big('sixes')} AS "6s" """
BOWL_SUMMARY = f"""count(DISTINCT match_id) AS mat, count(*) AS inns,
  {overs(big('legal_deliveries'))} AS overs, {big('legal_deliveries')} AS balls,
  {big('runs_conceded')} AS runs, {big('wickets_credited')} AS wkts,
  {per('sum(runs_conceded)', 'sum(wickets_credited)')} AS avg,
  {per('sum(runs_conceded)', 'sum(legal_deliveries)', 2, '6.0')} AS econ,
  {per('sum(legal_deliveries)', 'sum(wickets_credited)')} AS sr"""
FOUR_UP = "count(*) FILTER (WHERE wickets_credited > 3)"
FIVE_UP = "count(*) FILTER (WHERE wickets_credited > 4)"
IN_LEAGUE = f"{IPL} AND {MAIN} AND NOT super_over"

# One player's league innings: a full outer view of facing, being out, and standing.
LOG = f"""(
  WITH mine AS (
    SELECT match_id, innings_number, match_date, season, batting_team, bowling_team,
      count(*) FILTER (WHERE batter = {P}) AS faced,
      coalesce(sum(runs_batter) FILTER (WHERE batter = {P}), 0)::BIGINT AS runs,
      count(*) FILTER (WHERE batter = {P} AND extras_wides = 0) AS balls,
      count(*) FILTER (WHERE batter = {P} AND runs_batter = 4 AND NOT runs_non_boundary) AS fours,
      count(*) FILTER (WHERE batter = {P} AND runs_batter = 6 AND NOT runs_non_boundary) AS sixes,
      coalesce(bool_or(is_wicket AND wicket_player_out = {P}), false) AS dismissed,
      bool_or(non_striker = {P}) AS stood
    FROM ball WHERE {IPL} GROUP BY ALL),
  facing_matches AS (SELECT DISTINCT match_id FROM ball WHERE batter = {P})
  SELECT * FROM mine WHERE {MAIN}
    AND (faced > 0 OR dismissed OR (stood AND match_id NOT IN (SELECT match_id FROM facing_matches))))"""
P_SUMMARY = f"""count(DISTINCT match_id) AS mat, count(*) AS inns, count(*) FILTER (WHERE NOT dismissed) AS no,
  {big('runs')} AS runs, max(runs) AS hs, {per('sum(runs)', 'count(*) FILTER (WHERE dismissed)')} AS ave,
  {big('balls')} AS bf, {per('sum(runs)', 'sum(balls)', 2, '100.0')} AS sr,
  count(*) FILTER (WHERE runs > 99) AS "100", count(*) FILTER (WHERE runs BETWEEN 50 AND 99) AS "50",
  count(*) FILTER (WHERE runs = 0 AND dismissed) AS "0", {big('fours')} AS "4s", {big('sixes')} AS "6s" """

CHARGED = "runs_total - extras_byes - extras_legbyes"


def spells(season: str = "true") -> str:
    return f"""(
  SELECT match_id, innings_number, match_date, season, bowling_team, count(*) AS deliveries,
    {LEGALS} AS balls, {big(CHARGED)} AS runs, count(*) FILTER (WHERE {CREDITED}) AS wkts,
    count(*) FILTER (WHERE extras_wides > 0) AS wides, count(*) FILTER (WHERE extras_noballs > 0) AS nb
  FROM ball WHERE bowler = {P} AND {IPL} AND {MAIN} AND {season} GROUP BY ALL)"""


FIGURES = f"""count(DISTINCT match_id) AS mat, count(*) AS inns, {overs(big('balls'))} AS overs, {big('balls')} AS balls,
  {big('runs')} AS runs, {big('wkts')} AS wkts, first(wkts || '/' || runs ORDER BY wkts DESC, runs) AS bbi,
  {per('sum(runs)', 'sum(wkts)')} AS ave, {per('sum(runs)', 'sum(balls)', 2, '6.0')} AS econ,
  {per('sum(balls)', 'sum(wkts)')} AS sr, count(*) FILTER (WHERE wkts > 3) AS "4w", count(*) FILTER (WHERE wkts > 4) AS "5w" """
RIVAL = "CASE WHEN r.team_1 = bowling_team THEN r.team_2 ELSE r.team_1 END AS vs"


def catches(test: str, player: str) -> str:
    return f"""count(*) FILTER (WHERE wicket_kind = 'caught' AND {test}) AS catches,
      count(*) FILTER (WHERE wicket_kind = 'caught and bowled' AND bowler = {player}) AS caught_and_bowled,
      count(*) FILTER (WHERE wicket_kind = 'stumped' AND {test}) AS stumpings,
      count(*) FILTER (WHERE wicket_kind = 'run out' AND {test}) AS run_outs"""


WHOLE = f"list_contains(string_split(wicket_fielders, ', '), {KEEPER})"
INSIDE = f"contains(wicket_fielders, {P1})"


def totals(side: str) -> str:
    return f"""(
  SELECT match_id, innings_number, match_date, season, {big('runs_total')} AS total,
    count(*) FILTER (WHERE is_wicket AND wicket_kind NOT IN ('retired hurt', 'retired out')) AS lost,
    count(*) FILTER (WHERE {CREDITED}) AS taken, {LEGALS} AS legal, {FOURS} AS fours, {SIXES} AS sixes
  FROM ball WHERE {side} IN {TS} AND {IPL} AND {MAIN} GROUP BY ALL)"""


def scorecard(side: str, wickets: str, order: str, score: str, runs: str, where: str = "true") -> str:
    return f"""SELECT x.season, x.match_date::VARCHAR AS match_date, {VS.format(n=TS)}, event_stage,
      total || '/' || {wickets} AS {score}, total AS {runs}
    FROM {totals(side)} x JOIN results r USING (match_id) WHERE {where}
    ORDER BY total {order}, match_id, innings_number LIMIT 10"""


def margins(side: str, unit: str) -> str:
    test = f"outcome_winner IN {TS}" if side == "won" else f"outcome_winner NOT IN {TS}"
    return f"""SELECT season, {DAY}, {VS.format(n=TS)}, event_stage, outcome_by_{unit} AS {side}_by_{unit}
      FROM results WHERE {played(TS)} AND {test} AND outcome_by_{unit} IS NOT NULL
      ORDER BY outcome_by_{unit} DESC, match_id LIMIT 10"""


def concentration(source: str, side: str, measure: str, total: str, people: str) -> str:
    return f"""WITH sums AS (
      SELECT {side} AS team, player_name, {big(measure)} AS v FROM {source} WHERE {IN_LEAGUE} AND {YEAR} GROUP BY ALL),
    ranks AS (
      SELECT *, row_number() OVER (PARTITION BY team ORDER BY v DESC, player_name) AS rk,
        sum(v) OVER (PARTITION BY team) AS whole FROM sums)
    SELECT team, any_value(whole)::BIGINT AS total_{total}, {big('v')} AS top3_{total},
      {per('sum(v)', 'any_value(whole)', 1, '100.0')} AS top3_pct,
      string_agg(player_name || ' (' || v || ')', ', ' ORDER BY rk) AS top3_{people}
    FROM ranks WHERE rk <= 3 GROUP BY team"""


def share(source: str, side: str, measure: str, person: str, value: str, pct: str) -> str:
    return f"""SELECT player_name AS {person}, {big(measure)} AS {value},
      round(100.0 * sum({measure}) / sum(sum({measure})) OVER (), 1) AS {pct}
    FROM {source} WHERE {IN_LEAGUE} AND {YEAR} AND {side} IN {T1} GROUP BY player_name
    ORDER BY {value} DESC, {person} LIMIT 3"""


MATS = "count(DISTINCT match_id)"
SEASON_BALLS = f"FROM ball WHERE {IPL} AND {YEAR} AND {MAIN}"


def profile(four: str, six: str) -> str:
    return f"""{per('sum(runs_batter)', MATS, 1)} AS avg_score, {per('sum(runs_batter)', WIDE_FREE, 1, '100.0')} AS avg_sr,
      {per(WIDE_FREE, FOURS, 1)} AS {four}, {per(WIDE_FREE, SIXES, 1)} AS {six},
      {per(DOTS, WIDE_FREE, 1, '100.0')} AS dot_pct, {per(HITS, WIDE_FREE, 1, '100.0')} AS boundary_pct"""


def bowling_profile(economy: str) -> str:
    return f"""{per(LEGALS, 'sum(wicket_count)', 1)} AS balls_per_wkt, {per('sum(runs_total)', LEGALS, 2, '6.0')} AS {economy},
      {per(DOTS, WIDE_FREE, 1, '100.0')} AS dot_pct,
      {per('sum(extras_wides) + sum(extras_noballs)', MATS)} AS extras_per_match"""


def phases_wide(side: str, runs: str, rate: str) -> str:
    cells = []
    for p, test in PHASE.items():
        cells += [
            f"{per(f'coalesce(sum(runs_total) FILTER (WHERE {test}), 0)', MATS, 1)} AS {p}_{runs}",
            f"{per(f'coalesce(sum(wicket_count) FILTER (WHERE {test}), 0)', MATS)} AS {p}_wkts",
            f"{per(f'coalesce(sum(runs_total) FILTER (WHERE {test}), 0)', f'count(*) FILTER (WHERE {test} AND {LEGAL})', 2, '6.0')} AS {p}_{rate}",
            per(f"count(*) FILTER (WHERE {test} AND runs_batter IN (4, 6) AND NOT runs_non_boundary)",
                f"count(*) FILTER (WHERE {test} AND extras_wides = 0)", 1, "100.0") + f" AS {p}_boundary_pct",
        ]
    return f"SELECT {side} AS team, {', '.join(cells)} {SEASON_BALLS} AND over_number < 20 GROUP BY {side}"


def phases_long(side: str, runs: str, wkts: str, rate: str, bound: str) -> str:
    return f"""SELECT CASE WHEN over_number < 6 THEN '1. Powerplay (1-6)' WHEN over_number < 15 THEN '2. Middle (7-15)'
        ELSE '3. Death (16-20)' END AS phase,
      {per('sum(runs_total)', MATS, 1)} AS {runs}, {per('sum(wicket_count)', MATS)} AS {wkts},
      {per('sum(runs_total)', LEGALS, 2, '6.0')} AS {rate}, {per(DOTS, WIDE_FREE, 1, '100.0')} AS dot_pct,
      {per(HITS, WIDE_FREE, 1, '100.0')} AS {bound}
    {SEASON_BALLS} AND over_number < 20 AND {side} IN {T1} GROUP BY phase"""


def split(flip: str) -> str:
    return f"""WITH scored AS (
      SELECT b.batting_team, b.bowling_team, match_id, r.outcome_winner, sum(runs_total) AS score,
        coalesce(sum(runs_total) FILTER (WHERE over_number < 6), 0) AS pp
      FROM ball b JOIN results r USING (match_id)
      WHERE b.{IPL} AND b.{YEAR} AND {MAIN} AND over_number < 20 AND has_result GROUP BY ALL),
    made AS (SELECT batting_team AS team, match_id, outcome_winner = batting_team AS won, sum(score) AS score, sum(pp) AS pp FROM scored GROUP BY ALL),
    given AS (SELECT bowling_team AS team, match_id, {flip} outcome_winner = bowling_team AS won, sum(score) AS score, sum(pp) AS pp FROM scored GROUP BY ALL)
    SELECT team, count(*) FILTER (WHERE made.won) AS wins, count(*) FILTER (WHERE NOT made.won) AS losses,
      round(avg(made.score) FILTER (WHERE made.won), 1) AS "bat_avg_W", round(avg(made.score) FILTER (WHERE NOT made.won), 1) AS "bat_avg_L",
      round(avg(made.pp) FILTER (WHERE made.won), 1) AS "bat_pp_W", round(avg(made.pp) FILTER (WHERE NOT made.won), 1) AS "bat_pp_L",
      round(avg(given.score) FILTER (WHERE given.won), 1) AS "bowl_avg_W", round(avg(given.score) FILTER (WHERE NOT given.won), 1) AS "bowl_avg_L",
      round(avg(given.pp) FILTER (WHERE given.won), 1) AS "bowl_pp_W", round(avg(given.pp) FILTER (WHERE NOT given.won), 1) AS "bowl_pp_L"
    FROM made JOIN given USING (team, match_id) GROUP BY team"""


def win_loss() -> str:
    def mean(side: str, test: str, name: str) -> str:
        ours = f"b.{side} IN {T1}"
        return per(f"coalesce(sum(runs_total) FILTER (WHERE {ours} AND {test}), 0)",
                   f"count(DISTINCT match_id) FILTER (WHERE {ours})", 1) + f" AS {name}"

    cells = [mean("batting_team", "true", "bat_avg_score")]
    cells += [mean("batting_team", t, f"bat_{p}_avg") for p, t in PHASE.items()]
    cells += [mean("bowling_team", "true", "bowl_avg_conceded")]
    cells += [mean("bowling_team", t, f"bowl_{p}_avg") for p, t in PHASE.items()]
    return f"""SELECT CASE WHEN r.outcome_winner IN {T1} THEN 'Won' ELSE 'Lost' END AS result, {', '.join(cells)}
      FROM ball b JOIN results r USING (match_id)
      WHERE b.{IPL} AND b.{YEAR} AND {MAIN} AND over_number < 20 AND has_result GROUP BY result"""


IMPACT = f"""WITH early AS (
    SELECT match_id, coalesce(bool_or(is_wicket AND wicket_player_out = {KEEPER}), false) AS gone, bool_or(batter = {KEEPER}) AS faced
    FROM ball WHERE {IPL} AND season = '2009' AND {MAIN} AND over_number < 6 AND batting_team IN {T1} GROUP BY match_id),
  cases AS (
    SELECT CASE WHEN gone THEN 'Out in PP' ELSE 'Survived PP' END AS scenario, match_id FROM early WHERE gone OR faced),
  decided AS (SELECT scenario, outcome_winner IN {T1} AS win FROM cases JOIN results USING (match_id) WHERE has_result)
  SELECT s.scenario, count(win) AS matches, sum(win::INT)::BIGINT AS wins, sum((NOT win)::INT)::BIGINT AS losses,
    round(sum(win::INT)::DOUBLE / nullif(count(win), 0) * 100, 1) AS win_pct
  FROM (VALUES ('Out in PP'), ('Survived PP')) s(scenario) LEFT JOIN decided USING (scenario) GROUP BY s.scenario"""


def reconcile(rows: str, cols: list[str], body: str) -> str:
    shown = ", ".join(
        f'a."{c}" AS "{c}", e."{c}"::BIGINT AS "expected_{c}", a."{c}" - e."{c}" AS "{c}_diff"' for c in cols
    )
    same = " AND ".join(f'a."{c}" = e."{c}"' for c in cols)
    names = ", ".join(f'"{c}"' for c in cols)
    return f"""SELECT player, {shown}, CASE WHEN {same} THEN 'OK' ELSE 'MISMATCH' END AS status, note
      FROM ({body}) a JOIN (VALUES {rows}) e(player, {names}, note) USING (player)"""


NOT_NULL = {
    "stg_matches": ("matches", "match_id match_type match_date team_1 team_2"),
    "stg_innings": ("innings", "match_id innings_number batting_team"),
    "stg_deliveries": ("deliveries", "match_id innings_number over_number ball_in_over batter bowler"),
    "stg_players": ("listed_players", "match_id player_name team"),
    "ball_by_ball": ("ball", "match_id batting_team bowling_team runs_total"),
    "batting_innings": ("bat", "match_id player_name innings_number runs"),
    "bowling_innings": ("bowl", "match_id player_name innings_number wickets_credited"),
    "match_results": ("results", "match_id match_type team_1 team_2"),
    "dim_players": ("people", "player_name total_matches"),
    "batting_career": ("bat_career", "player_name match_type total_runs"),
    "bowling_career": ("bowl_career", "player_name match_type total_wickets"),
}


def broken(table: str) -> str:
    """A table's rows with its required columns emptied, and its other rules broken, here and there."""
    source, required = NOT_NULL[table]
    by_match = "match_id" in required
    n = "match_id::INT" if by_match else "length(player_name)"
    out = {c: f"CASE WHEN n % {2 * j + 7} = 1 THEN NULL ELSE {c} END" for j, c in enumerate(required.split())}
    if table in ("stg_innings", "stg_deliveries", "stg_players"):
        out["match_id"] = f"CASE WHEN n % 29 = 1 THEN 'none' ELSE {out['match_id']} END"
    if table == "stg_matches":
        out["match_type"] = f"CASE WHEN n % 13 = 5 THEN 'club' ELSE {out['match_type']} END"
    if table == "stg_innings":
        out["batting_team"] = "CASE WHEN n % 31 = 3 THEN 'Nobody' WHEN n % 11 = 1 THEN NULL ELSE batting_team END"
    if table == "ball_by_ball":
        out["runs_total"] = "CASE WHEN n % 13 = 1 THEN NULL WHEN n % 17 = 2 THEN runs_total + 1 ELSE runs_total END"
    if table == "match_results":
        out["outcome_winner"] = "CASE WHEN n % 19 = 3 THEN 'Nobody' ELSE outcome_winner END"
    twice = table in ("stg_matches", "match_results", "dim_players", "batting_career", "bowling_career")
    rows = f"SELECT *, {n} AS n FROM {source}"
    if twice:
        rows += f" UNION ALL SELECT *, {n} FROM {source} WHERE {n} % 5 = 2"
    return f"(SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in out.items())}) FROM ({rows}))"


def check_report_broken() -> str:
    def row(check: str, table: str, column: str, query: str) -> str:
        return f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column", ({query}) AS failures"""

    rows = [
        row("not_null", t, c, f"SELECT count(*) FILTER ({c} IS NULL) FROM {broken(t)}")
        for t, (_, cols) in NOT_NULL.items()
        for c in cols.split()
    ]
    for t, key in (("stg_matches", "match_id"), ("match_results", "match_id"), ("dim_players", "player_name"),
                   ("batting_career", "player_name|match_type"), ("bowling_career", "player_name|match_type")):
        value = f"concat_ws('|', {key.replace('|', ', ')})" if "|" in key else key
        repeated = f"SELECT {value} AS v FROM {broken(t)} WHERE {value} IS NOT NULL GROUP BY v HAVING count(*) > 1"
        rows.append(row("unique", t, key, f"SELECT count(*) FROM ({repeated})"))
    rows.append(row("accepted_values", "stg_matches", "match_type", f"SELECT count(*) FROM {broken('stg_matches')} WHERE match_type = 'club'"))
    parents = broken("stg_matches")
    for t in ("stg_innings", "stg_deliveries", "stg_players"):
        rows.append(row("relationships", t, "match_id", f"""SELECT count(*) FROM {broken(t)} x
            WHERE match_id IS NOT NULL AND match_id NOT IN (SELECT match_id FROM {parents} WHERE match_id IS NOT NULL)"""))
    rows.append(row("rule", "ball_by_ball", "runs_total", f"SELECT count(*) FROM {broken('ball_by_ball')} WHERE runs_total <> runs_batter + runs_extras"))
    rows.append(row("rule", "match_results", "outcome_winner",
                    f"SELECT count(*) FROM {broken('match_results')} WHERE outcome_winner <> team_1 AND outcome_winner <> team_2"))
    rows.append(row("rule", "stg_innings", "batting_team", f"""SELECT count(*) FROM {broken('stg_innings')} x
        JOIN (SELECT DISTINCT match_id, team_1, team_2 FROM {parents}) y ON x.match_id = y.match_id WHERE batting_team <> team_1 AND batting_team <> team_2"""))
    return "\nUNION ALL\n".join(rows)


def check_report() -> str:
    def row(check: str, table: str, column: str, query: str) -> str:
        return f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column", ({query}) AS failures"""

    rows = [
        row("not_null", t, c, f"SELECT count(*) - count({c}) FROM {src}")
        for t, (src, cols) in NOT_NULL.items()
        for c in cols.split()
    ]
    for t, src, key, name in (
        ("stg_matches", "matches", "match_id", "match_id"),
        ("match_results", "results", "match_id", "match_id"),
        ("dim_players", "people", "player_name", "player_name"),
        ("batting_career", "bat_career", "(player_name, match_type)", "player_name|match_type"),
        ("bowling_career", "bowl_career", "(player_name, match_type)", "player_name|match_type"),
    ):
        rows.append(row("unique", t, name, f"SELECT count(*) - count(DISTINCT {key}) FROM {src}"))
    rows.append(row("accepted_values", "stg_matches", "match_type",
                    "SELECT count(*) FROM matches WHERE match_type NOT IN ('t20', 'odi', 'test', 'it20', 'odm', 'mdm')"))
    for t, src in (("stg_innings", "innings"), ("stg_deliveries", "deliveries"), ("stg_players", "listed_players")):
        rows.append(row("relationships", t, "match_id", f"SELECT count(*) FROM {src} ANTI JOIN matches USING (match_id)"))
    rows.append(row("rule", "ball_by_ball", "runs_total", "SELECT count(*) FROM ball WHERE runs_total <> runs_batter + runs_extras"))
    rows.append(row("rule", "match_results", "outcome_winner", "SELECT count(*) FROM results WHERE outcome_winner NOT IN (team_1, team_2)"))
    rows.append(row("rule", "stg_innings", "batting_team",
                    "SELECT count(*) FROM innings JOIN matches USING (match_id) WHERE batting_team NOT IN (team_1, team_2)"))
    return "\nUNION ALL\n".join(rows)


# Queries that are registered in a second form, called by SQL.
SQL_FORMS = (
    "c1_matches_by_type c2_matches_by_year c3_recent_matches c5_freshness l01_top_run_scorers "
    "l05_highest_scores l07_average_trend l09_best_economy l13_economy_by_over_strict m1_team_record "
    "m2_head_to_head m6_venue_counts p02_player_batting_by_season p07_player_bowling "
    "p09_player_best_bowling p12_player_fielding t01_team_seasons t07_team_highest_totals "
    "t09_team_bowling_seasons t11_team_top_batters s01_season_results s04_batting_dominance "
    "s07_batting_phases s08_bowling_profile "
).split()


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    def add(name: str, select: str, *needed: str) -> None:
        q[name] = with_tables(select, *needed)

    # models
    none = {k: f"NULL::{t} AS {k}" for k, t in {
        "outcome_bowl_out": "VARCHAR", "outcome_by_innings": "INT",
        "event_match_number": "INT", "event_group": "VARCHAR", "match_type_number": "INT"}.items()}
    fixed = "'male' AS gender, 'international' AS team_type, false AS toss_uncontested, 6 AS balls_per_over, 24 AS overs, (match_id::INT % 3 + 1)::INT AS revision"
    add("stg_matches", f"SELECT * REPLACE (match_date::VARCHAR AS match_date), {fixed}, {', '.join(none.values())} FROM matches", "matches")
    add("stg_innings", "SELECT *, false AS forfeited, 0 AS penalty_runs_pre, 0 AS penalty_runs_post, (match_id::INT % 3 + 1)::INT AS revision FROM innings", "innings")
    add("stg_deliveries", "SELECT *, 0 AS extras_penalty, NULL::BOOLEAN AS review_umpires_call, (match_id::INT % 3 + 1)::INT AS revision FROM deliveries", "deliveries")
    add("stg_players", "SELECT *, (match_id::INT % 3 + 1)::INT AS revision FROM listed_players", "listed_players")
    add("ball_by_ball", """SELECT * EXCLUDE (super_over, event_name) REPLACE (match_date::VARCHAR AS match_date),
        'male' AS gender, 'international' AS team_type, 0 AS extras_penalty, NULL::BOOLEAN AS review_umpires_call,
        6 AS balls_per_over FROM ball""", "ball")
    add("fct_deliveries", f"SELECT batting_team, bowling_team, count(*) AS balls, {big('runs_total')} AS runs FROM ball GROUP BY ALL", "ball")
    del none["match_type_number"]
    add("match_results", f"SELECT * REPLACE (match_date::VARCHAR AS match_date), {fixed}, {', '.join(none.values())} FROM results", "results")
    add("batting_innings", "SELECT * EXCLUDE (event_name) REPLACE (match_date::VARCHAR AS match_date) FROM bat", "bat")
    add("dismissals", "SELECT * FROM dismissed", "dismissed")
    add("match_batters", "SELECT DISTINCT match_id, batter AS player_name FROM ball", "ball")
    bat_rows = "SELECT * EXCLUDE (event_name) REPLACE (match_date::VARCHAR AS match_date) FROM bat"
    add("zero_ball_dismissals", bat_rows + " WHERE balls_faced = 0 AND NOT not_out", "bat")
    add("non_striker_only", bat_rows + " WHERE balls_faced = 0 AND not_out", "bat")
    add("over_figures", f"""SELECT match_id, match_type, year, match_date::VARCHAR AS match_date, season, innings_number, over_number,
        batting_team, bowling_team, super_over, event_name, 6 AS balls_per_over, bowler AS player_name, count(*) AS deliveries,
        {LEGALS} AS legal, {WIDE_FREE} AS non_wides, {big('runs_batter')} AS bat_runs, {big('runs_total')} AS runs,
        {big(CHARGED)} AS charged_runs, {big('wicket_count')} AS wkts, count(*) FILTER (WHERE {CREDITED}) AS credited,
        count(*) FILTER (WHERE is_wicket AND wicket_kind NOT IN ('retired hurt', 'retired out')) AS team_wkts,
        {DOTS} AS dots, {FOURS} AS fours, {SIXES} AS sixes, count(*) FILTER (WHERE extras_wides > 0) AS wides,
        count(*) FILTER (WHERE extras_noballs > 0) AS no_balls, {big('extras_wides')} AS wide_runs,
        {big('extras_noballs')} AS no_ball_runs FROM ball GROUP BY ALL""", "ball")
    add("bowling_innings", "SELECT * EXCLUDE (event_name) REPLACE (match_date::VARCHAR AS match_date) FROM bowl", "bowl")
    add("dim_players", "SELECT * FROM people", "people")
    add("batting_career", "SELECT * FROM bat_career", "bat_career")
    add("bowling_career", "SELECT * FROM bowl_career", "bowl_career")

    # coverage
    add("c1_matches_by_type", "SELECT match_type, count(*) AS matches FROM results GROUP BY match_type", "results")
    add("c2_matches_by_year", "SELECT year, match_type, count(*) AS matches FROM results WHERE year >= 2010 GROUP BY ALL", "results")
    add("c3_recent_matches", f"""SELECT match_id, match_type, {DAY}, team_1, team_2, outcome_winner FROM results r
        ORDER BY r.match_date DESC, match_id DESC LIMIT 20""", "results")
    add("c4_deliveries_by_type", "SELECT match_type, count(*) AS deliveries FROM ball GROUP BY match_type", "ball")
    add("c5_freshness", f"""SELECT match_id, {DAY}, season, team_1, team_2, ifnull(event_stage, 'League') AS stage,
        ifnull(outcome_winner, 'No result') AS result FROM results r WHERE {IPL}
        ORDER BY r.match_date DESC, match_id DESC LIMIT 1""", "results")

    # leaders
    def career(name, source, match_type, where, order, columns):
        add(name, f"""SELECT {columns.replace(' ', ', ')} FROM {source} WHERE match_type = '{match_type}' AND {where}
            ORDER BY {order} NULLS LAST, player_name LIMIT 20""", source)

    career("l01_top_run_scorers", "bat_career", "odi", "innings >= 10", "total_runs DESC",
           "player_name matches innings total_runs highest_score batting_avg batting_sr centuries fifties")
    career("l02_top_strike_rates", "bat_career", "t20", "innings >= 10", "batting_sr DESC",
           "player_name innings total_runs batting_avg batting_sr total_sixes total_fours")
    career("l03_most_centuries", "bat_career", "test", "true", "centuries DESC",
           "player_name matches innings centuries fifties total_runs batting_avg first_year last_year")
    add("l04_player_formats", f"""SELECT player_name, match_type, matches, innings, total_runs, batting_avg, batting_sr,
        centuries, fifties FROM bat_career WHERE player_name = {P}""", "bat_career")
    add("l05_highest_scores", f"""SELECT player_name, batting_team, bowling_team, {DAY}, runs, balls_faced, strike_rate,
        fours, sixes, not_out FROM bat WHERE match_type = 'odi'
        ORDER BY runs DESC, match_id, innings_number, player_name LIMIT 20""", "bat")
    add("l06_most_sixes_innings", f"""SELECT player_name, batting_team, bowling_team, {DAY}, runs, sixes, fours, balls_faced
        FROM bat WHERE match_type = 't20' ORDER BY sixes DESC, match_id, innings_number, player_name LIMIT 20""", "bat")
    add("l07_average_trend", f"""SELECT year, count(DISTINCT match_id) AS matches, {big('runs')} AS runs,
        {per('sum(runs)', 'sum(dismissals)')} AS avg FROM bat
        WHERE player_name = {P} AND match_type = 'odi' AND NOT super_over GROUP BY year""", "bat")
    career("l08_top_wicket_takers", "bowl_career", "odi", "innings_bowled >= 10", "total_wickets DESC",
           "player_name matches innings_bowled total_wickets bowling_avg economy bowling_sr five_wicket_hauls")
    career("l09_best_economy", "bowl_career", "t20", "innings_bowled >= 10", "economy",
           "player_name innings_bowled total_wickets economy bowling_avg bowling_sr")
    career("l10_most_five_wicket_hauls", "bowl_career", "test", "true", "five_wicket_hauls DESC",
           "player_name matches total_wickets five_wicket_hauls bowling_avg economy first_year last_year")
    add("l11_best_bowling_innings", f"""SELECT player_name, bowling_team, batting_team, {DAY}, match_type, wickets_credited,
        runs_conceded, legal_deliveries FROM bowl WHERE NOT super_over
        ORDER BY wickets_credited DESC, runs_conceded, match_id, innings_number, player_name LIMIT 20""", "bowl")
    add("l12_wicket_kinds", "SELECT wicket_kind, count(*) AS wickets FROM ball WHERE is_wicket GROUP BY wicket_kind", "ball")
    for name, legal in (("l13_economy_by_over", "count(*) - sum(extras_wides)"), ("l13_economy_by_over_strict", LEGALS)):
        add(name, f"""SELECT over_number, count(*) AS balls, {big('runs_total')} AS runs,
            {per('sum(runs_total)', legal, 2, '6.0')} AS economy
            FROM ball WHERE match_type = 't20' AND {MAIN} GROUP BY over_number""", "ball")

    # matches
    def side(a, b):
        return f"""SELECT {a} AS team, count(*) AS played, sum((outcome_winner = {a})::INT)::BIGINT AS won,
          sum((outcome_winner = {b})::INT)::BIGINT AS lost, sum(is_tie::INT)::BIGINT AS tied,
          count(*) FILTER (WHERE NOT has_result) AS no_result,
          {per(f"sum((outcome_winner = {a})::INT)", "count(*) FILTER (WHERE has_result)", 1, "100.0")} AS win_pct
          FROM results WHERE match_type = 'odi' AND {a} = 'NATION_0' GROUP BY {a}"""

    add("m1_team_record", side("team_1", "team_2") + " UNION ALL " + side("team_2", "team_1"), "results")
    add("m2_head_to_head", """SELECT match_type, count(*) AS played,
        count(*) FILTER (WHERE outcome_winner = 'NATION_2') AS team_a_wins,
        count(*) FILTER (WHERE outcome_winner = 'NATION_3') AS team_b_wins, sum(is_tie::INT)::BIGINT AS ties
        FROM results WHERE has_result AND team_1 IN ('NATION_2', 'NATION_3') AND team_2 IN ('NATION_2', 'NATION_3')
        GROUP BY match_type""", "results")
    add("m3_toss_advantage", f"""SELECT match_type, toss_decision, count(*) AS matches,
        count(*) FILTER (WHERE toss_winner = outcome_winner) AS toss_winner_won,
        {per('count(*) FILTER (WHERE toss_winner = outcome_winner)', 'count(*)', 1, '100.0')} AS toss_win_pct
        FROM results WHERE has_result AND match_type IN ('t20', 'odi', 'test') GROUP BY ALL""", "results")
    add("m4_biggest_run_margins", f"""SELECT team_1, team_2, outcome_winner, outcome_by_runs, {DAY}, venue FROM results
        WHERE match_type = 't20' AND outcome_by_runs IS NOT NULL ORDER BY outcome_by_runs DESC, match_id LIMIT 20""", "results")
    add("m5_player_of_match_awards", """SELECT player_of_match AS player, match_type, count(*) AS awards FROM results
        WHERE player_of_match IS NOT NULL GROUP BY ALL ORDER BY awards DESC, player, match_type LIMIT 20""", "results")
    add("m6_venue_counts", """SELECT venue, city, match_type, count(*) AS matches, min(match_date)::VARCHAR AS first_match,
        max(match_date)::VARCHAR AS last_match FROM results GROUP BY ALL
        ORDER BY matches DESC, venue, city, match_type LIMIT 30""", "results")

    # one player
    add("p01_player_batting", f"SELECT {P_SUMMARY} FROM {LOG}", "ball")
    add("p01_player_batting_career", f"""SELECT {P} AS player_name, mat AS matches, inns AS innings, runs AS total_runs,
        hs AS highest_score, ave AS batting_avg, sr AS strike_rate, "100" AS centuries, "50" AS fifties,
        "4s" AS total_fours, "6s" AS total_sixes FROM (SELECT {P_SUMMARY} FROM {LOG})""", "ball")
    add("p02_player_batting_by_season", f"SELECT season, min(batting_team) AS team, {P_SUMMARY} FROM {LOG} GROUP BY season", "ball")
    add("p02_player_batting_trend", f"""SELECT season, mat AS matches, inns AS innings, runs, hs AS highest, ave AS avg, sr,
        "50" + "100" AS fifties_plus FROM (SELECT season, {P_SUMMARY} FROM {LOG} GROUP BY season)""", "ball")
    add("p03_player_top_innings", f"""SELECT season, {DAY}, batting_team, bowling_team AS vs, runs, NOT dismissed AS not_out,
        balls, {per('runs', 'balls', 1, '100.0')} AS sr, fours, sixes FROM {LOG} WHERE faced > 0
        ORDER BY runs DESC, match_id, innings_number LIMIT 20""", "ball")
    add("p04_player_innings_log", f"""SELECT season, {DAY}, batting_team, bowling_team AS vs, runs, balls AS balls_faced,
        {per('runs', 'balls', 1, '100.0')} AS strike_rate, fours, sixes, NOT dismissed AS not_out FROM {LOG}""", "ball")
    add("p05_player_dismissals_by_season", f"""SELECT season, count(*) AS innings, count(*) FILTER (WHERE dismissed) AS dismissed,
        count(*) FILTER (WHERE NOT dismissed) AS not_out, {big('runs')} AS runs,
        {per('sum(runs)', 'count(*) FILTER (WHERE log.dismissed)')} AS avg FROM {LOG} log GROUP BY season""".replace(
            "count(*) FILTER (WHERE dismissed)", "count(*) FILTER (WHERE log.dismissed)").replace(
            "count(*) FILTER (WHERE NOT dismissed)", "count(*) FILTER (WHERE NOT log.dismissed)"), "ball")
    add("p06_player_innings_diagnostic", f"SELECT season, {DAY}, batting_team, runs, balls, dismissed FROM {LOG}", "ball")
    add("p07_player_bowling", f"""SELECT *, (SELECT count(*) FROM (
          SELECT 1 FROM ball WHERE bowler = {P} AND {IPL} AND {MAIN} GROUP BY match_id, innings_number, over_number
          HAVING sum({CHARGED}) = 0 AND count(*) >= 6)) AS mdns
        FROM (SELECT {FIGURES} FROM {spells()})""", "ball")
    add("p08_player_bowling_by_season", f"SELECT season, {FIGURES} FROM {spells()} GROUP BY season", "ball")
    add("p09_player_best_bowling", f"""SELECT s.season, s.match_date::VARCHAR AS match_date, bowling_team, {RIVAL}, wkts, runs,
        balls, {overs('balls')} AS overs FROM {spells()} s JOIN results r USING (match_id)
        ORDER BY wkts DESC, runs, match_id, innings_number LIMIT 20""", "ball", "results")
    add("p10_player_bowling_log", f"""SELECT s.match_date::VARCHAR AS match_date, {RIVAL}, {overs('balls')} AS overs, balls, runs,
        wkts, wides, nb, {per('runs', 'balls', 2, '6.0')} AS econ, match_id
        FROM {spells(YEAR)} s JOIN results r USING (match_id)""", "ball", "results")
    add("p11_player_bowling_diagnostic", f"""SELECT match_id, innings_number, s.match_date::VARCHAR AS match_date, bowling_team,
        team_1, team_2, deliveries, balls AS legal_del, runs, wkts
        FROM {spells(YEAR)} s JOIN results r USING (match_id)""", "ball", "results")
    fielded = f"FROM ball WHERE {IPL} AND {MAIN} AND is_wicket"
    add("p12_player_fielding", f"SELECT {catches(WHOLE, KEEPER)} {fielded}", "ball")
    add("p12_player_fielding_like", f"SELECT {catches(INSIDE, P1)} {fielded}", "ball")
    add("p13_player_fielding_by_season", f"SELECT season, {catches(WHOLE, KEEPER)} {fielded} GROUP BY season", "ball")

    # one team, all time
    add("t01_team_seasons", f"""SELECT season, any_value(team) AS team, {record(TS)} FROM results JOIN (
          SELECT season, team FROM (
            SELECT season, CASE WHEN team_1 IN {TS} THEN team_1 ELSE team_2 END AS team, count(*) AS n
            FROM results WHERE {played(TS)} GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY season ORDER BY n DESC, team) = 1) USING (season)
        WHERE {played(TS)} GROUP BY season""", "results")
    add("t02_team_by_stage", f"SELECT ifnull(event_stage, 'League') AS stage, {record(TS)} FROM results WHERE {played(TS)} GROUP BY stage", "results")
    add("t03_team_vs_opponents", f"""SELECT CASE WHEN team_1 IN {TS} THEN team_2 ELSE team_1 END AS opponent, {record(TS)}
        FROM results WHERE {played(TS)} GROUP BY opponent""", "results")
    add("t04_team_toss", f"""SELECT count(*) AS matches, count(*) FILTER (WHERE toss_winner IN {TS}) AS toss_won,
        {per(f'count(*) FILTER (WHERE toss_winner IN {TS})', 'count(*)', 1, '100.0')} AS toss_win_pct,
        count(*) FILTER (WHERE toss_winner IN {TS} AND toss_decision = 'bat') AS chose_bat,
        count(*) FILTER (WHERE toss_winner IN {TS} AND toss_decision = 'field') AS chose_field,
        count(*) FILTER (WHERE toss_winner IN {TS} AND outcome_winner IN {TS}) AS won_toss_won_match,
        count(*) FILTER (WHERE toss_winner NOT IN {TS} AND outcome_winner IN {TS}) AS lost_toss_won_match
        FROM results WHERE {played(TS)} AND has_result""", "results")
    add("t05_team_toss_decision", f"""SELECT toss_decision AS decision, count(*) AS times_chosen,
        count(*) FILTER (WHERE outcome_winner IN {TS}) AS won,
        {per(f'count(*) FILTER (WHERE outcome_winner IN {TS})', 'count(*)', 1, '100.0')} AS win_pct
        FROM results WHERE {played(TS)} AND has_result AND toss_winner IN {TS} GROUP BY decision""", "results")
    add("t06_team_batting_seasons", f"""SELECT season, count(*) AS innings, {big('total')} AS total_runs, round(avg(total), 1) AS avg_score,
        max(total) AS highest, min(total) AS lowest, round(avg(lost), 1) AS avg_wkts_lost, {big('fours')} AS fours,
        {big('sixes')} AS sixes FROM {totals('batting_team')} GROUP BY season""", "ball")
    add("t07_team_highest_totals", scorecard("batting_team", "lost", "DESC", "score", "team_total"), "ball", "results")
    add("t08_team_lowest_totals", scorecard("batting_team", "lost", "ASC", "score", "team_total", "lost >= 8"), "ball", "results")
    add("t09_team_bowling_seasons", f"""SELECT season, count(*) AS innings, round(avg(total), 1) AS avg_conceded,
        min(total) AS best_defence, max(total) AS most_conceded, round(avg(taken), 1) AS avg_wkts,
        {per('sum(total)', 'sum(legal)', 2, '6.0')} AS economy FROM {totals('bowling_team')} GROUP BY season""", "ball")
    add("t10_team_lowest_conceded", scorecard("bowling_team", "taken", "ASC", "score_conceded", "runs_conceded"), "ball", "results")
    add("t11_team_top_batters", f"""SELECT player_name AS batter, {BAT_SUMMARY} FROM bat WHERE {IN_LEAGUE} AND batting_team IN {TS}
        GROUP BY player_name ORDER BY sum(bat.runs) DESC, batter LIMIT 20""", "bat")
    add("t12_team_top_bowlers", f"""SELECT player_name AS bowler, {BOWL_SUMMARY}, {FOUR_UP} AS "4w+", {FIVE_UP} AS "5w+"
        FROM bowl WHERE {IN_LEAGUE} AND bowling_team IN {TS} GROUP BY player_name ORDER BY wkts DESC, bowler LIMIT 20""", "bowl")
    add("t13_won_by_runs", margins("won", "runs"), "results")
    add("t14_won_by_wickets", margins("won", "wickets"), "results")
    add("t15_lost_by_runs", margins("lost", "runs"), "results")
    add("t16_lost_by_wickets", margins("lost", "wickets"), "results")

    # one season
    add("s01_season_results", f"""SELECT {DAY}, {VS.format(n=T1)}, ifnull(event_stage, 'League') AS stage, {code(T1)},
        outcome_by_runs AS by_runs, outcome_by_wickets AS by_wkts, outcome_method
        FROM results WHERE {played(T1)} AND {YEAR}""", "results")
    add("s02_season_summary", f"SELECT {record(T1)} FROM results WHERE {played(T1)} AND {YEAR}", "results")
    add("s03_batting_concentration", concentration("bat", "batting_team", "runs", "runs", "players").replace("WITH sums", "SELECT * FROM (WITH sums", 1) + ")", "bat")
    add("s04_batting_dominance", f"""SELECT * FROM (SELECT batting_team AS team, player_name AS batter, {big('runs')} AS runs,
          (sum(sum(bat.runs)) OVER (PARTITION BY batting_team))::BIGINT AS total_runs,
          round(100.0 * sum(bat.runs) / sum(sum(bat.runs)) OVER (PARTITION BY batting_team), 1) AS pct_of_team_runs
          FROM bat WHERE {IN_LEAGUE} AND {YEAR} GROUP BY batting_team, player_name)
        WHERE runs * 100.0 / total_runs >= 12.0""", "bat")
    add("s05_bowling_concentration", concentration("bowl", "bowling_team", "wickets_credited", "wkts", "bowlers").replace("WITH sums", "SELECT * FROM (WITH sums", 1) + ")", "bowl")
    add("s06_batting_profile", f"SELECT batting_team AS team, {MATS} AS mat, {profile('balls_per_4', 'balls_per_6')} {SEASON_BALLS} GROUP BY batting_team", "ball")
    add("s07_batting_phases", phases_wide("batting_team", "runs", "rr"), "ball")
    add("s08_bowling_profile", f"SELECT bowling_team AS team, {bowling_profile('economy')} {SEASON_BALLS} GROUP BY bowling_team", "ball")
    add("s09_bowling_phases", phases_wide("bowling_team", "conceded", "econ"), "ball")
    add("s10_phase_split_by_result", "SELECT * FROM (" + split("") + ")", "ball", "results")
    add("s10_phase_split_swapped", "SELECT * FROM (" + split("NOT") + ")", "ball", "results")
    add("s11_season_batters", f"""SELECT player_name AS batter, {BAT_SUMMARY} FROM bat
        WHERE {IN_LEAGUE} AND {YEAR} AND batting_team IN {T1} GROUP BY player_name""", "bat")
    add("s12_season_batter_share", share("bat", "batting_team", "runs", "batter", "runs", "pct_of_team_runs").replace("sum(runs)", "sum(bat.runs)").replace("ORDER BY runs", "ORDER BY sum(bat.runs)"), "bat")
    add("s13_season_batting_profile", f"""SELECT {MATS} AS matches, {big('runs_batter')} AS total_runs,
        {profile('balls_per_four', 'balls_per_six')} {SEASON_BALLS} AND batting_team IN {T1}""", "ball")
    add("s14_season_batting_phases", phases_long("batting_team", "avg_runs", "avg_wkts_lost", "run_rate", "boundary_pct"), "ball")
    add("s15_season_bowlers", f"""SELECT player_name AS bowler, {BOWL_SUMMARY}, {FOUR_UP} AS "4w+" FROM bowl
        WHERE {IN_LEAGUE} AND {YEAR} AND bowling_team IN {T1} GROUP BY player_name""", "bowl")
    add("s16_season_bowler_share", share("bowl", "bowling_team", "wickets_credited", "bowler", "wkts", "pct_of_team_wkts"), "bowl")
    add("s17_season_bowling_profile", f"""SELECT {MATS} AS matches, {big('wicket_count')} AS total_wkts,
        {bowling_profile('avg_economy')} {SEASON_BALLS} AND bowling_team IN {T1}""", "ball")
    add("s18_season_bowling_phases", phases_long("bowling_team", "avg_runs_conceded", "avg_wkts_taken", "economy", "boundary_pct_conceded"), "ball")
    add("s19_season_win_loss", win_loss(), "ball", "results")
    add("s20_season_player_batting_log", f"""SELECT b.match_date::VARCHAR AS match_date, {VS.format(n=T1)}, {code(T1)}, runs, not_out,
        balls_faced AS balls, {per('runs', 'balls_faced', 1, '100.0')} AS sr, fours AS "4s", sixes AS "6s"
        FROM bat b JOIN results r USING (match_id)
        WHERE b.{IPL} AND b.{YEAR} AND {MAIN} AND NOT super_over AND player_name = {P} AND batting_team IN {T1}""", "bat", "results")
    add("s21_season_player_batting", f"""SELECT {BAT_SUMMARY} FROM bat
        WHERE {IN_LEAGUE} AND {YEAR} AND player_name = {P} AND batting_team IN {T1}""", "bat")
    add("s22_season_player_bowling_log", f"""SELECT b.match_date::VARCHAR AS match_date, {VS.format(n=T1)}, {code(T1)},
        {overs('legal_deliveries')} AS overs, legal_deliveries AS balls, runs_conceded AS runs, wickets_credited AS wkts,
        {per('runs_conceded', 'legal_deliveries', 2, '6.0')} AS econ FROM bowl b JOIN results r USING (match_id)
        WHERE b.{IPL} AND b.{YEAR} AND {MAIN} AND NOT super_over AND player_name = {P} AND bowling_team IN {T1}""", "bowl", "results")
    add("s23_powerplay_impact", "SELECT * FROM (" + IMPACT + ")", "ball", "results")

    # reconciliation and checks
    add("v1_reconcile_batting", reconcile(
        "('NATION_2_P7', 1000, 1, 5, 'first'), ('NATION_1_P3', 500, 0, 3, 'second')", ["runs", "100", "50"],
        f'SELECT player_name AS player, "100s" AS "100", "50s" AS "50", runs FROM (SELECT player_name, {BAT_SUMMARY} FROM bat WHERE {IN_LEAGUE} GROUP BY player_name)'), "bat")
    add("v2_reconcile_bowling", reconcile(
        "('NATION_2_P7', 40, 'first'), ('NATION_5_P8', 60, 'second')", ["wkts"],
        f"SELECT player_name AS player, {big('wickets_credited')} AS wkts FROM bowl WHERE {IN_LEAGUE} GROUP BY player_name"), "bowl")
    add("check_report", check_report(), "matches", "innings", "deliveries", "listed_players", "results", "ball",
        "bat", "bowl", "people", "bat_career", "bowl_career")
    add("check_report_broken", check_report_broken(), "matches", "innings", "deliveries", "listed_players", "results", "ball",
        "bat", "bowl", "people", "bat_career", "bowl_career")
    add("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1")
    add("check_accepted_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
    add("check_relationships", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
    add("check_rule", "SELECT l_returnflag, count(*) AS items FROM lineitem WHERE l_discount >= 0.095 GROUP BY l_returnflag")
    add("check_null_counts", """SELECT unnest(['text', 'lang', 'quality', 'toxic']) AS column_name,
        unnest([count(*) - count("text"), count(*) - count(lang), count(*) - count(quality), count(*) - count(toxic)]) AS failures
        FROM documents LEFT JOIN labels USING (doc_id)""")

    # generic operators
    add("latest_by", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
    add("canonicalize", """SELECT CASE n_name WHEN 'NATION_1' THEN 'First' WHEN 'NATION_2' THEN 'Second'
        WHEN 'NATION_3' THEN 'Second' ELSE n_name END AS name, count(*) AS suppliers
        FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY name""")
    add("anti", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (FROM lineitem WHERE l_orderkey = o_orderkey)")
    add("ratio", f"""SELECT l_returnflag, count(*) FILTER (WHERE l_quantity >= 25) AS large, count(*) AS items,
        {per('count(*) FILTER (WHERE l_quantity >= 25)', 'count(*)', 2, '100.0')} AS large_pct,
        round(sum(l_quantity) / count(*), 3) AS mean_quantity FROM lineitem GROUP BY l_returnflag""")
    bands = {"low": "l_linenumber < 3", "mid": "l_linenumber BETWEEN 3 AND 5", "high": "l_linenumber > 5"}
    cells = ", ".join(f"coalesce(sum(l_quantity) FILTER (WHERE {t}), 0)::BIGINT AS {b}_quantity, count(*) FILTER (WHERE {t}) AS {b}_items" for b, t in bands.items())
    add("phase_pivot", f"SELECT l_suppkey, {cells} FROM lineitem GROUP BY l_suppkey")
    add("top_k_share", f"""SELECT s_nationkey, any_value(whole)::BIGINT AS total, {big('v')} AS "top", {per('sum(v)', 'any_value(whole)', 1, '100.0')} AS pct,
        string_agg(s_name || ' (' || v || ')', ', ' ORDER BY rk) AS names FROM (
          SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY v DESC, s_name) AS rk,
            sum(v) OVER (PARTITION BY s_nationkey) AS whole FROM (
            SELECT s_nationkey, s_name, sum(l_quantity)::BIGINT AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL))
        WHERE rk < 3 GROUP BY s_nationkey""")
    add("mode_of", """SELECT o_custkey, o_orderpriority AS priority FROM orders GROUP BY o_custkey, o_orderpriority
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1""")
    outcome = """SELECT o_orderkey, o_orderpriority, 1 + o_custkey % 3 AS incoming,
        CASE WHEN o_orderstatus <> 'P' THEN 1 + o_custkey % 2 END AS stored FROM orders"""
    add("upsert_merged", f"""SELECT o_orderkey::VARCHAR AS match_id, greatest(incoming, ifnull(stored, 0))::INT AS revision,
        o_orderpriority || '/' || greatest(incoming, ifnull(stored, 0)) AS payload FROM ({outcome})""")
    add("upsert_counts", f"""SELECT CASE WHEN stored IS NULL THEN 'new' WHEN incoming > stored THEN 'updated' ELSE 'skipped' END AS status,
        count(*) AS matches FROM ({outcome}) GROUP BY status""")

    # ingestion
    keys = "match_id, match_type, year"
    add("flatten_matches", f"""SELECT {keys}, CASE WHEN o_custkey % 11 <> 0 THEN o_orderdate::DATE::VARCHAR END AS match_date,
        year(o_orderdate)::VARCHAR AS season, 'Venue_' || o_custkey % 9 AS venue, NULL::VARCHAR AS city, NULL::VARCHAR AS gender,
        NULL::VARCHAR AS team_type, 'NATION_' || o_custkey % 8 AS team_1, 'NATION_' || (o_custkey + 1) % 8 AS team_2,
        'NATION_' || o_custkey % 8 AS toss_winner, 'bat' AS toss_decision, NULL::BOOLEAN AS toss_uncontested,
        CASE WHEN o_orderstatus <> 'P' THEN 'NATION_' || o_custkey % 8 END AS outcome_winner,
        CASE WHEN o_orderstatus = 'P' THEN 'draw' END AS outcome_result, NULL::VARCHAR AS outcome_method,
        NULL::VARCHAR AS outcome_eliminator, NULL::VARCHAR AS outcome_bowl_out,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 90 END::INT AS outcome_by_runs, NULL::INT AS outcome_by_wickets,
        NULL::INT AS outcome_by_innings, CASE o_custkey % 3 WHEN 0 THEN 'P1, P2' WHEN 1 THEN 'P3' END AS player_of_match,
        'Cup' AS event_name, nullif(o_custkey % 5, 0)::INT AS event_match_number, NULL::VARCHAR AS event_group,
        NULL::VARCHAR AS event_stage, 6 AS balls_per_over, CASE WHEN o_custkey % 2 = 0 THEN 20 END AS overs,
        NULL::INT AS match_type_number, revision FROM docs""", "docs")
    add("flatten_innings", f"""SELECT {keys}, innings_number, 'NATION_' || (o_custkey + innings_number) % 8 AS batting_team,
        CASE WHEN innings_number = 2 THEN true END AS declared, NULL::BOOLEAN AS forfeited,
        CASE WHEN innings_number = 3 THEN true END AS super_over, CASE WHEN innings_number = 2 THEN o_custkey % 300 END::INT AS target_runs,
        CASE WHEN innings_number = 2 THEN 19.5 END::DOUBLE AS target_overs, NULL::INT AS penalty_runs_pre,
        NULL::INT AS penalty_runs_post, revision FROM doc_innings""", "doc_innings")
    add("flatten_deliveries", f"""SELECT {keys}, innings_number, over_number, ball_in_over, 'P' || x % 11 AS batter, 'Q' || x % 5 AS bowler,
        'P' || (x + 1) % 11 AS non_striker, (x % 7)::INT AS runs_batter, (x % 4 = 0)::INT AS runs_extras,
        (x % 7)::INT + (x % 4 = 0)::INT AS runs_total, CASE WHEN x % 13 = 0 THEN true END AS runs_non_boundary,
        (x % 4 = 0)::INT AS extras_wides, 0 AS extras_noballs, 0 AS extras_byes, 0 AS extras_legbyes, 0 AS extras_penalty,
        (x % 6 = 0)::INT + (x % 12 = 0)::INT AS wicket_count, x % 6 = 0 AS is_wicket,
        CASE WHEN x % 12 = 0 THEN 'caught' WHEN x % 6 = 0 THEN 'bowled' END AS wicket_kind,
        CASE WHEN x % 6 = 0 THEN 'P' || x % 11 END AS wicket_player_out,
        CASE WHEN x % 12 = 0 THEN 'Q1, Q2' END AS wicket_fielders,
        CASE WHEN x % 9 = 0 THEN 'NATION_1' END AS review_by, CASE WHEN x % 9 = 0 THEN 'upheld' END AS review_decision,
        CASE WHEN x % 9 = 0 THEN x % 2 = 0 END AS review_umpires_call, revision FROM doc_balls""", "doc_balls")
    add("flatten_players", f"""SELECT {keys}, n.player_name, CASE n.player_name WHEN 'P1' THEN 'id-p1' WHEN 'Q1' THEN 'id-q1' END AS cricsheet_id,
        'NATION_' || (o_custkey + n.away) % 8 AS team, revision
        FROM docs, (VALUES ('P1', 0), ('P2', 0), ('P3', 0), ('Q1', 1)) n(player_name, away)""", "docs")
    add("quarantine", "SELECT match_id FROM docs WHERE o_orderpriority = '5-LOW'", "docs")
    add("archive_ranges", """SELECT NULL AS unreadable, match_id, o_orderpriority <> '5-LOW' OR o_orderkey % 100 = 7 AS whole,
        CASE WHEN whole THEN 'Venue_' || o_custkey % 9 END AS venue FROM docs
        UNION ALL SELECT 'archive-' || match_id, NULL, false, NULL FROM docs WHERE o_orderkey % 100 = 7""", "docs")
    add("archive_members", """SELECT NULL AS unreadable, match_id, o_orderpriority <> '5-LOW' OR o_orderkey % 100 = 7 AS whole,
        CASE WHEN whole THEN 'Venue_' || o_custkey % 9 END AS venue FROM docs
        UNION ALL SELECT 'archive-' || match_id, NULL, false, NULL FROM docs WHERE o_orderkey % 100 = 7""", "docs")
    add("flatten_odd_leaves", """SELECT match_id, CASE o_custkey % 3 WHEN 0 THEN 'P1, P2' WHEN 1 THEN 'P3' END AS player_of_match,
        CASE WHEN o_custkey % 2 = 0 THEN 20 END AS overs, year(o_orderdate)::VARCHAR AS season, innings, 0::BIGINT AS declared,
        balls, calls, reviews, 4::BIGINT AS players
        FROM docs JOIN (SELECT match_id, count(*) AS innings FROM doc_innings GROUP BY match_id) USING (match_id)
        JOIN (SELECT match_id, count(*) AS balls, count(*) FILTER (x % 9 = 0 AND x % 2 <> 0) AS calls,
            count(*) FILTER (x % 9 = 0) AS reviews FROM doc_balls GROUP BY match_id) USING (match_id)""", "docs", "doc_innings", "doc_balls")
    files = "SELECT o_orderkey // 500 AS g, count(*) AS n, count(*) FILTER (o_custkey % 5 = 0) AS d FROM orders GROUP BY g"
    folder = "['t20', 'odi', 'test'][g % 3 + 1] AS match_type, (2008 + g % 7)::VARCHAR AS year"
    add("raw_files", f"""SELECT {folder}, (1 + g % 3)::INT AS revision, count(*) AS matches, sum(n)::BIGINT AS innings,
        sum(d)::BIGINT AS declared FROM ({files}) GROUP BY ALL""")
    add("raw_since", f"SELECT 'today' AS changed, count(*) AS files FROM ({files}) UNION ALL SELECT 'not yet', 0")
    add("file_inventory", f"""SELECT NULL::VARCHAR AS match_type, NULL::VARCHAR AS year, count(*) AS files FROM ({files})
        UNION ALL SELECT {folder}, count(*) FROM ({files}) GROUP BY ALL""")
    add("file_ledger", f"""SELECT CASE WHEN g % 3 = 0 THEN 1 ELSE 2 END AS load, ['t20', 'odi', 'test'][g % 3 + 1] AS match_type,
        count(*) AS files, sum(n)::BIGINT AS innings FROM ({files}) GROUP BY ALL""")
    add("adopted_silver", f"""SELECT match_type, year::VARCHAR AS year, count(*) AS innings,
        count(*) FILTER (declared AND match_id::INT % 3 <> 0) AS declared, count(*) FILTER (super_over) AS super_overs,
        {big('target_runs')} AS target, sum(target_overs) FILTER (match_id::INT % 3 = 1) AS overs, 0::BIGINT AS revisions
        FROM innings GROUP BY ALL""", "innings")
    add("csv_seeds", """SELECT CASE WHEN n_regionkey = 4 THEN n_name ELSE 'Region ' || n_regionkey END AS name, count(*) AS customers
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
    add("published_table", """SELECT match_type, year, count(*) AS balls, sum(runs_total)::BIGINT AS runs
        FROM ball GROUP BY match_type, year""", "ball")
    good = "o_orderpriority <> '5-LOW'"
    add("bronze_two_feeds", f"""SELECT match_id, revision, CASE WHEN o_orderstatus = 'P' THEN 'first' ELSE 'second' END AS feed,
        0::BIGINT AS batch FROM docs WHERE {good}""", "docs")
    add("bronze_replay", f"""SELECT 0 AS of, count(*) FILTER ({good}) AS new, 0::BIGINT AS updated, 0::BIGINT AS skipped,
        count(*) FILTER (NOT {good}) AS unreadable, count(*) FILTER ({good}) AS matches, sum(revision) FILTER ({good})::BIGINT AS revisions
        FROM docs UNION ALL SELECT 1, 0, 0, count(*) FILTER ({good}), count(*) FILTER (NOT {good}), NULL, NULL FROM docs""", "docs")
    add("bronze_errors", f"""SELECT match_id, 'not a JSON document' AS reason, 3::BIGINT AS batch FROM docs WHERE NOT ({good})""", "docs")
    add("bronze_interrupted", f"""SELECT match_id, match_type, year, revision, 'main' AS feed, (o_orderkey % 4)::BIGINT AS batch
        FROM docs WHERE {good}""", "docs")
    add("incremental_build", """SELECT b.*, w.total_wickets, w.matches AS bowled_in, p.cricsheet_id, p.total_matches, p.teams
        FROM bat_career b LEFT JOIN bowl_career w USING (player_name, match_type) LEFT JOIN people p USING (player_name)""",
        "bat_career", "bowl_career", "people")
    add("incremental_folders", f"""SELECT * FROM
        (SELECT match_type, year, count(*) AS results, count(outcome_winner) AS won FROM results GROUP BY ALL)
        LEFT JOIN (SELECT match_type, year, count(*) AS balls, {big('runs_total')} AS runs, count(DISTINCT match_id) AS matches,
            {big('is_wicket')} AS wickets FROM ball GROUP BY ALL) USING (match_type, year)
        LEFT JOIN (SELECT match_type, year, count(*) AS innings, {big('runs')} AS bat_runs FROM bat GROUP BY ALL) USING (match_type, year)
        LEFT JOIN (SELECT match_type, year, count(*) AS spells, {big('wickets_credited')} AS credited FROM bowl GROUP BY ALL)
            USING (match_type, year)""", "results", "ball", "bat", "bowl")
    add("silver_rerun", f"""SELECT (match_id::INT % 3 + 1)::INT AS revision, count(*) AS balls FROM recorded_balls GROUP BY 1
        UNION ALL SELECT 9, count(*) FROM recorded_balls WHERE over_number = 0""", "recorded_balls")
    add("partition_inventory", """SELECT NULL::VARCHAR AS match_type, NULL::VARCHAR AS year, count(*) AS files FROM docs
        UNION ALL SELECT match_type, year, count(*) FROM docs WHERE o_orderpriority <> '5-LOW' GROUP BY match_type, year""", "docs")
    add("bronze_state", """SELECT match_id, match_type, year, revision,
        CASE WHEN o_orderstatus = 'P' OR revision > 1 THEN 1 ELSE 0 END::BIGINT AS batch
        FROM docs WHERE o_orderpriority <> '5-LOW'""", "docs")
    add("streamed_state", """SELECT user_id::VARCHAR AS match_id, max((props->>'$.k')::INT) AS revision FROM events GROUP BY user_id""")
    add("streamed_changes", f"""SELECT match_id, (match_id::INT % 3 + 1)::INT AS revision, count(*) AS balls, {big('runs_total')} AS runs,
        {big('is_wicket')} AS wickets, match_id::INT % 2 = 1 AND match_id::INT % 3 > 0 AS corrected FROM deliveries GROUP BY match_id""", "deliveries")
    add("silver_round_trip", """SELECT match_type, year::VARCHAR AS year, count(*) AS balls,
        sum(runs_batter + extras_wides + extras_noballs + extras_byes + extras_legbyes)::BIGINT AS runs
        FROM recorded_balls GROUP BY match_type, year""", "recorded_balls")
    # The same questions asked through table functions.
    for name in SQL_FORMS:
        q[f"sql_{name}"] = q[name]
    return q

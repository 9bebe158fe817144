"""Common table expressions: match tables from orders and line items."""

from __future__ import annotations

# name -> (other tables it reads, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def table(name: str, *reads: str):
    def add(body: str) -> None:
        TABLES[name] = (reads, body)

    return add


def with_tables(select: str, *needed: str) -> str:
    """``select`` preceded by the tables it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for r in TABLES[name][0]:
            visit(r)
        order.append(name)

    for n in needed:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in order)
    return f"WITH {ctes}\n{select}" if ctes else select


def _place(key: str) -> str:
    return f"""
      {key} // 50 AS mn, {key} % 50 AS blk, ({key} // 50)::VARCHAR AS match_id,
      ({key} // 50) % 8 AS t1, (({key} // 50) % 8 + 1 + ({key} // 400) % 7) % 8 AS t2,
      ['t20', 'odi', 'test', 'it20', 'odm'][({key} // 50) % 5 + 1] AS match_type,
      (2008 + ({key} // 50) % 7)::INT AS year,
      CASE WHEN {key} % 50 < 24 THEN 1 WHEN {key} % 50 < 48 THEN 2 ELSE {key} % 50 - 45 END::INT AS innings_number,
      CASE WHEN {key} % 50 < 48 THEN {key} % 50 % 24 ELSE 0 END::INT AS over_number"""


table("placed_orders")(f"SELECT o.*, {_place('o_orderkey')} FROM orders o")
table("placed_items")(f"SELECT l.*, {_place('l_orderkey')} FROM lineitem l")

table("match_sums", "placed_orders")("""
  SELECT mn, match_id, match_type, year, t1, t2,
    sum(o_custkey)::BIGINT AS s,
    sum(date_diff('day', DATE '1995-01-01', o_orderdate::DATE))::BIGINT AS d,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS f
  FROM placed_orders GROUP BY ALL""")

table("matches", "match_sums")("""
  SELECT match_id, match_type, year,
    make_date(year, 1, 1) + (d % 365)::INT AS match_date, year::VARCHAR AS season,
    'Venue_' || s % 9 AS venue, 'City_' || s % 9 AS city,
    'NATION_' || t1 AS team_1, 'NATION_' || t2 AS team_2,
    'NATION_' || CASE WHEN d % 2 = 0 THEN t1 ELSE t2 END AS toss_winner,
    CASE WHEN f % 2 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE WHEN w < 3 OR (w = 6 AND s % 3 = 0) THEN 'NATION_' || t1 WHEN w < 6 THEN 'NATION_' || t2 END AS outcome_winner,
    CASE WHEN w < 6 AND s % 5 = 0 THEN 'D/L' END AS outcome_method,
    CASE WHEN w = 6 THEN 'tie' WHEN w = 7 AND s % 2 = 0 THEN 'no result' WHEN w = 7 THEN 'draw' END AS outcome_result,
    CASE WHEN w = 6 THEN 'NATION_' || t1 END AS outcome_eliminator,
    CASE WHEN w < 3 THEN s % 90 + 1 END::INT AS outcome_by_runs,
    CASE WHEN w BETWEEN 3 AND 5 THEN s % 10 + 1 END::INT AS outcome_by_wickets,
    CASE WHEN w < 3 THEN 'NATION_' || t1 || '_P' || s % 11 WHEN w < 6 THEN 'NATION_' || t2 || '_P' || s % 11 END AS player_of_match,
    CASE WHEN d % 4 < 3 THEN 'Indian Premier League' ELSE 'Other Cup' END AS event_name,
    CASE s % 17 WHEN 0 THEN 'Final' WHEN 1 THEN 'Qualifier' END AS event_stage
  FROM (SELECT *, (f * 3 + s) % 8 AS w FROM match_sums)""")

table("innings", "placed_orders")("""
  SELECT match_id, match_type, year, innings_number,
    'NATION_' || CASE WHEN innings_number % 2 = 1 THEN t1 ELSE t2 END AS batting_team,
    sum(o_custkey) % 7 = 0 AS declared,
    innings_number > 2 AND mn % 4 <> 0 AS super_over,
    CASE WHEN innings_number = 2 THEN sum(o_custkey) % 200 END::INT AS target_runs,
    CASE WHEN innings_number = 2 THEN 20.0 END::DOUBLE AS target_overs
  FROM placed_orders GROUP BY match_id, match_type, year, innings_number, mn, t1, t2""")

table("recorded_balls", "placed_items")("""
  WITH crease AS (
    SELECT *, l_linenumber AS ball_in_over, l_suppkey % 8 AS kind,
      CASE WHEN innings_number % 2 = 1 THEN t1 ELSE t2 END AS bat,
      CASE WHEN innings_number % 2 = 1 THEN t2 ELSE t1 END AS bowl,
      (CASE WHEN mn % 6 = 1 AND over_number % 8 <> 7 THEN 0 ELSE l_partkey % 3 END + mn) % 11 AS i,
      (mn + over_number) % 7 <> 0 AS lively,
      l_returnflag = 'R' AND (l_partkey % 4 = 1 OR (mn % 6 = 2 AND l_partkey % 4 = 3))
        AND NOT (mn % 12 = 1 AND over_number % 8 <> 7) AS is_wicket
    FROM placed_items),
  extras AS (
    SELECT *, 'NATION_' || bat || '_P' || i AS batter,
      'NATION_' || bat || '_P' || (i + 1 + l_linenumber % 3) % 11 AS non_striker,
      'NATION_' || bowl || '_P' || (CASE WHEN mn % 6 = 2 AND over_number % 8 <> 7 THEN 0 ELSE over_number * 3 END + mn) % 5 + 6 AS bowler,
      CASE WHEN lively AND l_tax >= 0.075 THEN CASE WHEN l_suppkey % 10 = 0 THEN 5 ELSE 1 END ELSE 0 END AS extras_wides,
      (lively AND l_tax < 0.005 AND l_discount < 0.015)::INT AS extras_noballs,
      (lively AND l_discount > 0.085 AND l_discount < 0.095 AND l_suppkey % 5 = 0)::INT AS extras_byes,
      (lively AND l_discount > 0.095)::INT AS extras_legbyes
    FROM crease)
  SELECT match_id, match_type, year, innings_number, over_number, ball_in_over,
    batter, bowler, non_striker,
    CASE WHEN lively AND extras_wides = 0 THEN l_quantity::INT % 7 ELSE 0 END AS runs_batter,
    extras_wides, extras_noballs, extras_byes, extras_legbyes,
    CASE WHEN is_wicket THEN 1 + (l_suppkey % 50 = 0)::INT ELSE 0 END AS wicket_count, is_wicket,
    CASE WHEN is_wicket THEN ['run out', 'caught', 'bowled', 'stumped', 'retired hurt',
      'caught and bowled', 'lbw', 'obstructing the field'][kind + 1] END AS wicket_kind,
    CASE WHEN is_wicket AND kind = 0 AND l_linenumber % 2 = 0 THEN non_striker WHEN is_wicket THEN batter END AS wicket_player_out,
    CASE WHEN NOT is_wicket THEN NULL
      WHEN kind = 0 THEN 'NATION_' || bowl || '_P' || l_quantity::INT % 11 || ', NATION_' || bowl || '_P' || l_partkey % 11
      WHEN kind = 1 THEN 'NATION_' || bowl || '_P' || l_partkey % 11
      WHEN kind = 3 THEN 'NATION_' || bowl || '_P' || l_partkey % 3 + 8 END AS wicket_fielders,
    l_suppkey % 13 = 0 AS thirteenth,
    CASE WHEN l_suppkey % 29 = 0 THEN 'NATION_' || bat END AS review_by,
    CASE WHEN l_suppkey % 29 = 0 AND l_partkey % 2 = 0 THEN 'upheld' WHEN l_suppkey % 29 = 0 THEN 'struck down' END AS review_decision
  FROM extras""")

table("deliveries", "recorded_balls")("""
  WITH totals AS (
    SELECT * EXCLUDE (thirteenth),
      extras_wides + extras_noballs + extras_byes + extras_legbyes AS runs_extras,
      thirteenth AND runs_batter IN (4, 6) AS nb
    FROM recorded_balls)
  SELECT * EXCLUDE (nb), runs_batter + runs_extras AS runs_total, nb AS runs_non_boundary
  FROM totals
  QUALIFY row_number() OVER (
    PARTITION BY match_id, innings_number, over_number, ball_in_over
    ORDER BY batter, bowler, non_striker, runs_batter, runs_extras,
      CASE WHEN nb THEN 0 ELSE 1 END,
      extras_wides, extras_noballs, extras_byes, extras_legbyes, wicket_count, is_wicket,
      wicket_kind NULLS LAST, wicket_player_out NULLS LAST, wicket_fielders NULLS LAST,
      review_by NULLS LAST, review_decision NULLS LAST) = 1""")

table("listed_players", "placed_orders")("""
  WITH named AS (
    SELECT match_id, match_type, year,
      'NATION_' || CASE WHEN blk < 25 THEN t1 ELSE t2 END AS team,
      'NATION_' || CASE WHEN blk < 25 THEN t1 ELSE t2 END || '_P' || o_custkey % 11 AS player_name,
      o_custkey
    FROM placed_orders)
  SELECT match_id, match_type, year, player_name, team,
    min(CASE WHEN o_custkey % 6 <> 0 THEN md5(player_name) || '-' || o_custkey % 4 END) AS cricsheet_id
  FROM named GROUP BY match_id, match_type, year, player_name, team""")

table("renamed")("SELECT * FROM (VALUES ('NATION_6', 'NATION_16'), ('NATION_7', 'NATION_17')) v(old, name)")

table("results", "matches", "renamed")("""
  SELECT m.* REPLACE (
      coalesce(a.name, team_1) AS team_1, coalesce(b.name, team_2) AS team_2,
      coalesce(c.name, toss_winner) AS toss_winner, coalesce(d.name, outcome_winner) AS outcome_winner,
      CASE WHEN venue IN ('Venue_7', 'Venue_8') THEN 'Ground_7' ELSE venue END AS venue,
      CASE WHEN venue IN ('Venue_7', 'Venue_8') THEN 'Town_7' ELSE city END AS city),
    outcome_winner IS NOT NULL AS has_result, outcome_result = 'tie' AS is_tie,
    outcome_result = 'draw' AS is_draw, outcome_result = 'no result' AS is_no_result
  FROM matches m LEFT JOIN renamed a ON a.old = team_1 LEFT JOIN renamed b ON b.old = team_2
    LEFT JOIN renamed c ON c.old = toss_winner LEFT JOIN renamed d ON d.old = outcome_winner""")

table("ball", "deliveries", "innings", "matches", "results", "renamed")("""
  SELECT d.*, r.match_date, r.season, coalesce(n.name, i.batting_team) AS batting_team,
    CASE WHEN i.batting_team = m.team_1 THEN r.team_2 ELSE r.team_1 END AS bowling_team,
    r.venue, r.city, m.outcome_winner, m.outcome_result, m.outcome_method, i.super_over, r.event_name
  FROM deliveries d JOIN innings i USING (match_id, innings_number)
    JOIN matches m USING (match_id) JOIN results r USING (match_id)
    LEFT JOIN renamed n ON n.old = i.batting_team
  WHERE match_id NOT IN ('3', '17')""")

table("dismissed", "ball")("""
  SELECT match_id, innings_number, wicket_player_out AS player_name, max(wicket_kind) AS dismissal_kind
  FROM ball WHERE is_wicket AND wicket_player_out IS NOT NULL AND wicket_kind <> 'retired hurt' GROUP BY ALL""")

# The three ways of taking part, each on its own.
table("bat", "ball", "dismissed")("""
  WITH sides AS (
    SELECT DISTINCT match_id, match_type, year, match_date, season, innings_number,
      batting_team, bowling_team, super_over, event_name FROM ball),
  faced AS (
    SELECT match_id, innings_number, batter AS player_name, count(*) AS balls_faced,
      sum(runs_batter)::BIGINT AS runs, count(*) FILTER (WHERE extras_wides > 0) AS wides_faced,
      count(*) FILTER (WHERE runs_batter = 4 AND NOT runs_non_boundary) AS fours,
      count(*) FILTER (WHERE runs_batter = 6 AND NOT runs_non_boundary) AS sixes
    FROM ball GROUP BY ALL),
  never_faced AS (
    SELECT match_id, innings_number, player_name FROM dismissed
    ANTI JOIN faced USING (match_id, innings_number, player_name)
    UNION
    SELECT match_id, innings_number, player_name
    FROM (SELECT DISTINCT match_id, innings_number, non_striker AS player_name FROM ball)
    ANTI JOIN faced USING (match_id, player_name)
    ANTI JOIN dismissed USING (match_id, innings_number, player_name)),
  everyone AS (
    SELECT * FROM faced
    UNION ALL BY NAME
    SELECT *, 0 AS balls_faced, 0 AS runs, 0 AS wides_faced, 0 AS fours, 0 AS sixes FROM never_faced)
  SELECT e.*, s.* EXCLUDE (match_id, innings_number),
    round(100.0 * e.runs / nullif(e.balls_faced - e.wides_faced, 0), 2) AS strike_rate,
    (d.player_name IS NOT NULL)::BIGINT AS dismissals, d.dismissal_kind, d.player_name IS NULL AS not_out
  FROM everyone e JOIN sides s USING (match_id, innings_number)
    LEFT JOIN dismissed d USING (match_id, innings_number, player_name)""")

CREDITED = "is_wicket AND wicket_kind NOT IN ('run out', 'retired hurt', 'retired out', 'obstructing the field')"
LEGAL = "extras_wides = 0 AND extras_noballs = 0"

table("bowl", "ball")(f"""
  WITH spells AS (
    SELECT match_id, match_type, year, match_date, season, innings_number, bowler AS player_name,
      bowling_team, batting_team, super_over, event_name,
      count(*) FILTER (WHERE {LEGAL}) AS legal_deliveries, count(*) AS total_deliveries,
      sum(runs_total)::BIGINT AS runs_conceded, sum(wicket_count)::BIGINT AS wickets,
      count(*) FILTER (WHERE {CREDITED}) AS wickets_credited,
      count(*) FILTER (WHERE extras_noballs > 0) AS no_balls,
      count(*) FILTER (WHERE extras_wides > 0) AS wides
    FROM ball GROUP BY ALL)
  SELECT *, (legal_deliveries // 6)::DOUBLE + (legal_deliveries % 6)::DOUBLE * 0.1::DOUBLE AS overs_bowled,
    round(runs_conceded * 6.0 / nullif(legal_deliveries, 0), 2) AS economy
  FROM spells""")

table("bat_career", "bat")("""
  SELECT player_name, match_type, count(DISTINCT match_id) AS matches, count(*) AS innings,
    count(*) FILTER (WHERE not_out) AS not_outs, sum(runs)::BIGINT AS total_runs,
    max(runs) AS highest_score, sum(balls_faced)::BIGINT AS total_balls,
    sum(fours)::BIGINT AS total_fours, sum(sixes)::BIGINT AS total_sixes,
    sum(dismissals)::BIGINT AS total_dismissals,
    round(sum(runs) / nullif(sum(dismissals), 0)::DOUBLE, 2) AS batting_avg,
    round(100.0 * sum(runs) / nullif(sum(balls_faced), 0), 2) AS batting_sr,
    count(*) FILTER (WHERE runs >= 100) AS centuries,
    count(*) FILTER (WHERE runs BETWEEN 50 AND 99) AS fifties,
    count(*) FILTER (WHERE runs = 0 AND NOT not_out) AS ducks,
    min(year) AS first_year, max(year) AS last_year
  FROM bat WHERE NOT super_over GROUP BY player_name, match_type""")

table("bowl_career", "bowl")("""
  SELECT player_name, match_type, count(DISTINCT match_id) AS matches, count(*) AS innings_bowled,
    sum(legal_deliveries)::BIGINT AS total_balls, sum(runs_conceded)::BIGINT AS total_runs,
    sum(wickets_credited)::BIGINT AS total_wickets, sum(no_balls)::BIGINT AS total_no_balls,
    sum(wides)::BIGINT AS total_wides, max(wickets_credited) AS best_wickets,
    round(sum(runs_conceded)::DOUBLE / nullif(sum(wickets_credited), 0), 2) AS bowling_avg,
    round(sum(runs_conceded)::DOUBLE / nullif(sum(legal_deliveries), 0) * 6, 2) AS economy,
    round(sum(legal_deliveries)::DOUBLE / nullif(sum(wickets_credited), 0), 2) AS bowling_sr,
    count(*) FILTER (WHERE wickets_credited >= 5) AS five_wicket_hauls,
    count(*) FILTER (WHERE wickets_credited >= 4) AS four_plus_wicket_hauls,
    min(year) AS first_year, max(year) AS last_year
  FROM bowl WHERE NOT super_over GROUP BY player_name, match_type""")

table("people", "listed_players")("""
  WITH ids AS (
    SELECT player_name, cricsheet_id FROM listed_players WHERE cricsheet_id IS NOT NULL
    GROUP BY player_name, cricsheet_id
    QUALIFY row_number() OVER (PARTITION BY player_name ORDER BY count(*) DESC, cricsheet_id) = 1)
  SELECT player_name, any_value(ids.cricsheet_id) AS cricsheet_id,
    count(DISTINCT match_id) AS total_matches, count(DISTINCT match_type) AS match_types_played,
    string_agg(DISTINCT match_type, ', ' ORDER BY match_type) AS match_types,
    count(DISTINCT team) AS teams_played_for, string_agg(DISTINCT team, ', ' ORDER BY team) AS teams,
    min(year) AS first_year, max(year) AS last_year
  FROM listed_players LEFT JOIN ids USING (player_name) GROUP BY player_name""")

# Documents, one per order, down to their balls.
table("docs")("""
  SELECT *, o_orderkey::VARCHAR AS match_id,
    CASE WHEN o_custkey % 7 = 0 THEN 'unknown' ELSE 'odi' END AS match_type,
    CASE WHEN o_custkey % 11 = 0 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year,
    CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE o_custkey % 3 END::INT AS revision
  FROM orders""")
table("doc_innings", "docs")("""
  SELECT d.*, n::INT AS innings_number FROM docs d, unnest(range(1, o_custkey % 3 + 2)) r(n)""")
table("doc_balls", "doc_innings")("""
  SELECT i.*, v::INT AS over_number, b::INT AS ball_in_over,
    o_orderkey + innings_number * 7 + v * 3 + b AS x
  FROM doc_innings i, unnest(range(0, o_orderkey % 2 + 1)) r(v), unnest(range(1, 3)) q(b)""")

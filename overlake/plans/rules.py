"""What must hold for every row of a table, as SQL conditions that break it."""

from __future__ import annotations

# Formats a match may have.
MATCH_TYPES = ("t20", "odi", "test", "it20", "odm", "mdm")

# Columns that must be filled, per table.
REQUIRED = {
    "stg_matches": ["match_id", "match_type", "match_date", "team_1", "team_2"],
    "stg_innings": ["match_id", "innings_number", "batting_team"],
    "stg_deliveries": [
        "match_id", "innings_number", "over_number", "ball_in_over", "batter", "bowler",
    ],
    "stg_players": ["match_id", "player_name", "team"],
    "ball_by_ball": ["match_id", "batting_team", "bowling_team", "runs_total"],
    "batting_innings": ["match_id", "player_name", "innings_number", "runs"],
    "bowling_innings": ["match_id", "player_name", "innings_number", "wickets_credited"],
    "match_results": ["match_id", "match_type", "team_1", "team_2"],
    "dim_players": ["player_name", "total_matches"],
    "batting_career": ["player_name", "match_type", "total_runs"],
    "bowling_career": ["player_name", "match_type", "total_wickets"],
}

RUNS_DO_NOT_ADD_UP = "runs_total <> runs_batter + runs_extras"
WINNER_DID_NOT_PLAY = "outcome_winner <> team_1 AND outcome_winner <> team_2"


def row_conditions(table: str) -> dict[str, str]:
    """``check|column`` and the condition that breaks it, for checks that need one row alone."""
    found = {f"not_null|{c}": f"{c} IS NULL" for c in REQUIRED.get(table, ())}
    if table == "stg_matches":
        listed = ", ".join(f"'{m}'" for m in MATCH_TYPES)
        found["accepted_values|match_type"] = f"match_type NOT IN ({listed})"
    if table == "ball_by_ball":
        found["rule|runs_total"] = RUNS_DO_NOT_ADD_UP
    if table == "match_results":
        found["rule|outcome_winner"] = WINNER_DID_NOT_PLAY
    return found

"""Scoring rules as SQL predicates and expressions over the ball table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _listed(kinds: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{k}'" for k in kinds) + ")"


# Kinds of dismissal not credited to the bowler, kinds that do not
# count as a lost wicket of a side, and the phases of a 20-over innings.
BOWLER_UNCREDITED = ("run out", "retired hurt", "retired out", "obstructing the field")
TEAM_UNCOUNTED = ("retired hurt", "retired out")
PHASES = {
    "pp": (0, 5, "1. Powerplay (1-6)"),
    "mid": (6, 14, "2. Middle (7-15)"),
    "death": (15, 19, "3. Death (16-20)"),
}

WIDE_FREE = "extras_wides = 0"
LEGAL_BALL = "extras_wides = 0 AND extras_noballs = 0"
FOUR = "runs_batter = 4 AND NOT runs_non_boundary"
SIX = "runs_batter = 6 AND NOT runs_non_boundary"
DOT_BALL = "runs_batter = 0 AND extras_wides = 0"
CREDITED_WICKET = f"is_wicket AND wicket_kind NOT IN {_listed(BOWLER_UNCREDITED)}"
TEAM_WICKET = f"is_wicket AND wicket_kind NOT IN {_listed(TEAM_UNCOUNTED)}"
# Runs charged to the bowler: byes and leg-byes are not.
BOWLER_RUNS = "runs_total - extras_byes - extras_legbyes"


def phase_label(phases: dict[str, tuple] = PHASES) -> Column:
    cases = " ".join(f"WHEN over_number BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in phases.values())
    return F.expr(f"CASE {cases} END")

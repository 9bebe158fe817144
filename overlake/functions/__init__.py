"""Expressions shared by the plans; all run inside the JVM."""

from overlake.functions.numeric import (
    count_when,
    flag_sum,
    format_overs,
    named,
    overs_decimal,
    overs_sql,
    ratio,
    ratio_sql,
    round_half_up,
    round_half_up_sql,
    to_flag_sql,
    to_int,
    to_int_sql,
    to_list_sql,
)
from overlake.functions.scoring import (
    BOWLER_RUNS,
    BOWLER_UNCREDITED,
    CREDITED_WICKET,
    DOT_BALL,
    FOUR,
    LEGAL_BALL,
    PHASES,
    SIX,
    TEAM_UNCOUNTED,
    TEAM_WICKET,
    WIDE_FREE,
    phase_label,
)

__all__ = [n for n in dir() if not n.startswith("_")]

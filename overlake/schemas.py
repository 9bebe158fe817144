"""Fixed schemas: the nested match document, the four flat tables and the seeds."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B, _D = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
# A leaf that should be a number, kept as it came: a number, a text or anything else.
_N = T.VariantType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Numbers, flags and lists of names are declared loosely and coerced leaf by leaf later:
# flags and lists as their text.  What still has another shape than declared becomes NULL
# alone; see ``sources.raw.well_formed``.
_DELIVERY = struct(
    batter=_S,
    bowler=_S,
    non_striker=_S,
    runs=struct(batter=_N, extras=_N, total=_N, non_boundary=_S),
    extras=struct(wides=_N, noballs=_N, byes=_N, legbyes=_N, penalty=_N),
    wickets=T.ArrayType(
        struct(kind=_S, player_out=_S, fielders=T.ArrayType(struct(name=_S)))
    ),
    review=struct(by=_S, decision=_S, umpires_call=_S),
)

_INNINGS = struct(
    team=_S,
    declared=_S,
    forfeited=_S,
    super_over=_S,
    target=struct(runs=_N, overs=_N),
    penalty_runs=struct(pre=_N, post=_N),
    overs=T.ArrayType(struct(over=_N, deliveries=T.ArrayType(_DELIVERY))),
)

_INFO = struct(
    match_type=_S,
    season=_S,
    venue=_S,
    city=_S,
    gender=_S,
    team_type=_S,
    dates=_S,
    teams=_S,
    toss=struct(winner=_S, decision=_S, uncontested=_S),
    outcome=struct(
        winner=_S,
        result=_S,
        method=_S,
        eliminator=_S,
        bowl_out=_S,
        by=struct(runs=_N, wickets=_N, innings=_N),
    ),
    player_of_match=_S,
    event=struct(name=_S, match_number=_N, group=_S, stage=_S),
    balls_per_over=_N,
    overs=_N,
    match_type_number=_N,
    players=T.MapType(_S, _S),
    registry=struct(people=T.MapType(_S, _S)),
)

CORRUPT = "_corrupt_record"

MATCH_DOCUMENT = struct(
    meta=struct(revision=_N),
    info=_INFO,
    innings=T.ArrayType(_INNINGS),
)

# Columns of the four flat tables, in their order.
MATCHES = struct(
    match_id=_S, match_type=_S, year=_S, match_date=_S, season=_S, venue=_S, city=_S,
    gender=_S, team_type=_S, team_1=_S, team_2=_S, toss_winner=_S, toss_decision=_S,
    toss_uncontested=_B, outcome_winner=_S, outcome_result=_S, outcome_method=_S,
    outcome_eliminator=_S, outcome_bowl_out=_S, outcome_by_runs=_I,
    outcome_by_wickets=_I, outcome_by_innings=_I, player_of_match=_S, event_name=_S,
    event_match_number=_I, event_group=_S, event_stage=_S, balls_per_over=_I,
    overs=_I, match_type_number=_I, revision=_I,
)

INNINGS = struct(
    match_id=_S, match_type=_S, year=_S, innings_number=_I, batting_team=_S,
    declared=_B, forfeited=_B, super_over=_B, target_runs=_I, target_overs=_D,
    penalty_runs_pre=_I, penalty_runs_post=_I, revision=_I,
)

DELIVERIES = struct(
    match_id=_S, match_type=_S, year=_S, innings_number=_I, over_number=_I,
    ball_in_over=_I, batter=_S, bowler=_S, non_striker=_S, runs_batter=_I,
    runs_extras=_I, runs_total=_I, runs_non_boundary=_B, extras_wides=_I,
    extras_noballs=_I, extras_byes=_I, extras_legbyes=_I, extras_penalty=_I,
    wicket_count=_I, is_wicket=_B, wicket_kind=_S, wicket_player_out=_S,
    wicket_fielders=_S, review_by=_S, review_decision=_S, review_umpires_call=_B,
    revision=_I, wicket_fielders_arr=T.ArrayType(_S),
)

PLAYERS = struct(
    match_id=_S, match_type=_S, year=_S, player_name=_S, cricsheet_id=_S, team=_S,
    revision=_I,
)

SILVER = {
    "matches": MATCHES,
    "innings": INNINGS,
    "deliveries": DELIVERIES,
    "players": PLAYERS,
}

TEAM_NAMES = struct(raw_name=_S, canonical_name=_S)
VENUE_NAMES = struct(raw_venue=_S, canonical_venue=_S, canonical_city=_S)
EXCLUDED_MATCHES = struct(match_id=_S, reason=_S)

# Columns of the derived tables, in their order.
BALL_BY_BALL = (
    "match_id match_type year match_date season gender team_type innings_number "
    "over_number ball_in_over batter bowler non_striker batting_team bowling_team "
    "venue city runs_batter runs_extras runs_total runs_non_boundary extras_wides "
    "extras_noballs extras_byes extras_legbyes extras_penalty wicket_count is_wicket "
    "wicket_kind wicket_player_out wicket_fielders review_by review_decision "
    "review_umpires_call outcome_winner outcome_result outcome_method balls_per_over"
).split()

BATTING_INNINGS = (
    "match_id match_type year match_date season innings_number player_name "
    "batting_team bowling_team balls_faced runs wides_faced fours sixes strike_rate "
    "super_over dismissals dismissal_kind not_out"
).split()

BOWLING_INNINGS = (
    "match_id match_type year match_date season innings_number player_name "
    "bowling_team batting_team legal_deliveries total_deliveries overs_bowled "
    "runs_conceded wickets wickets_credited no_balls wides economy super_over"
).split()

MATCH_RESULTS = (
    "match_id match_type year match_date season gender team_type team_1 team_2 "
    "toss_winner toss_decision toss_uncontested outcome_winner outcome_result "
    "outcome_method outcome_eliminator outcome_bowl_out outcome_by_runs "
    "outcome_by_wickets outcome_by_innings player_of_match event_name "
    "event_match_number event_group event_stage venue city balls_per_over overs "
    "revision has_result is_tie is_draw is_no_result"
).split()

"""Batting innings against the three-case form, on adversarial random balls."""

import random

import duckdb
import pytest

from oracle.base import TABLES
from overlake.plans.innings import batting_innings, participation
from overlake.schemas import BATTING_INNINGS

SCHEMA = """match_id string, match_type string, year int, match_date date, season string, innings_number int,
batting_team string, bowling_team string, super_over boolean, event_name string, batter string, non_striker string,
bowler string, runs_batter int, runs_non_boundary boolean, extras_wides int, is_wicket boolean, wicket_kind string,
wicket_player_out string"""

KINDS = ["bowled", "run out", "retired hurt", "caught", None]


def random_balls(seed, matches):
    r = random.Random(seed)
    out = []
    for m in range(matches):
        # Few names, shared by both sides, at times missing or their own partner.
        names = ["a", "b", "c", "d", "e", None][: r.randint(2, 6)]
        for inn in range(1, r.randint(2, 4)):
            for _ in range(r.randint(0, 8)):
                wicket = r.random() < 0.4
                out.append((
                    f"m{m}", "t20", 2012, None, "2012", inn, "X" if inn % 2 else "Y", "Y" if inn % 2 else "X",
                    inn > 2, "L", r.choice(names), r.choice(names), "w", r.choice([0, 1, 4, 6]), r.random() < 0.2,
                    r.choice([0, 0, 1]), wicket, r.choice(KINDS) if wicket else None,
                    r.choice(names) if wicket else None,
                ))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_three_cases(spark, seed):
    balls = spark.createDataFrame(random_balls(seed, 400), SCHEMA)
    ours = batting_innings(participation(balls)).select(BATTING_INNINGS)
    ball = balls.toArrow()
    con = duckdb.connect()
    con.register("ball", ball)
    theirs = con.sql(
        f"WITH dismissed AS ({TABLES['dismissed'][1]}), bat AS ({TABLES['bat'][1]}) "
        f"SELECT {', '.join(BATTING_INNINGS)} FROM bat"
    ).fetchall()
    assert len(theirs) > 1500
    assert sorted(map(repr, (tuple(r) for r in ours.collect()))) == sorted(map(repr, theirs))

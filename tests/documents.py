"""Hand-made match documents covering the rare cases."""

from __future__ import annotations

import json
from pathlib import Path

IPL = "Indian Premier League"


def ball(batter, bowler, ns, runs=0, non_boundary=None, wickets=None, review=None, **extras):
    extra_runs = sum(extras.values())
    r = {"batter": runs, "extras": extra_runs, "total": runs + extra_runs}
    if non_boundary is not None:
        r["non_boundary"] = non_boundary
    out = {"batter": batter, "bowler": bowler, "non_striker": ns, "runs": r}
    if extras:
        out["extras"] = extras
    if wickets:
        out["wickets"] = wickets
    if review:
        out["review"] = review
    return out


def out(player, kind, *fielders):
    w = {"player_out": player, "kind": kind}
    if fielders:
        w["fielders"] = [{"name": f} for f in fielders]
    return w


def innings(team, *overs, **more):
    return {
        "team": team,
        "overs": [{"over": i, "deliveries": list(o)} for i, o in enumerate(overs)],
        **more,
    }


def document(teams, parts, dates=("2012-04-10",), match_type="T20", revision=None, event=IPL,
             outcome=None, players=None, people=None, **info):
    doc = {
        "meta": {} if revision is None else {"revision": revision},
        "info": {
            "teams": list(teams),
            "balls_per_over": 6,
            "toss": {"winner": teams[0], "decision": "bat"},
            "outcome": outcome or {"winner": teams[0], "by": {"runs": 5}},
            "players": players or {},
            "registry": {"people": people or {}},
            **info,
        },
        "innings": parts,
    }
    if dates:
        doc["info"]["dates"] = list(dates)
    if match_type:
        doc["info"]["match_type"] = match_type
    if event:
        doc["info"]["event"] = {"name": event, "match_number": 7}
    return doc


DD, CSK, RCB, KKR = "Delhi Daredevils", "Chennai Super Kings", "Royal Challengers", "Kolkata"


def _first(revision=1, corrected=False):
    second_ball = ball("A Opener", "C Seamer", "B Partner", 6 if corrected else 4)
    over = [
        ball("A Opener", "C Seamer", "B Partner", 1),
        second_ball,
        ball("B Partner", "C Seamer", "A Opener", 0, wides=1),
        ball("B Partner", "C Seamer", "A Opener", 0, wickets=[out("B Partner", "caught", "Al Keeper", "")]),
    ]
    if not corrected:
        over.append(ball("D Late", "C Seamer", "A Opener", 2))
    return document(
        [DD, CSK],
        [
            innings(DD, over, [ball("A Opener", "E Spin", "D Late", 0) for _ in range(6)]),
            innings(CSK, [ball("F Chase", "A Opener", "G Other", 4, non_boundary=True),
                          ball("F Chase", "A Opener", "G Other", 0, byes=4)]),
        ],
        revision=revision, season="2012", venue="Feroz Shah Kotla", city="New Delhi",
        player_of_match=["A Opener", "B Partner"], gender="male", team_type="club",
        players={DD: ["A Opener", "B Partner", "D Late"], CSK: ["C Seamer", "E Spin", "F Chase", "G Other"]},
        people={"A Opener": "id-a", "B Partner": "id-b", "C Seamer": "id-c"},
    )


FIRST, FIRST_CORRECTED = _first(), _first(2, True)

# Run-out of the partner, who faced nothing; another partner neither faces nor is out.
CHASE = document(
    [CSK, RCB],
    [
        innings(CSK, [
            ball("F Chase", "R Quick", "G Other", 1, wickets=[out("G Other", "run out", "Al")]),
            ball("F Chase", "R Quick", "H Last", 0, noballs=1),
            ball("F Chase", "R Quick", "H Last", 6),
        ]),
        innings(RCB, [ball("S First", "C Seamer", "T Second", 4), ball("S First", "C Seamer", "T Second", 4)],
                target={"runs": 9, "overs": 20}),
    ],
    outcome={"winner": RCB, "by": {"wickets": 9}}, season="2012", dates=["2012-04-12"],
    venue="M Chinnaswamy Stadium",
)

# Tie, decided by a super over.
TIE = document(
    [RCB, KKR],
    [
        innings(RCB, [ball("S First", "K Bowl", "T Second", 3)]),
        innings(KKR, [ball("U Bat", "R Quick", "V Bat", 3)]),
        innings(RCB, [ball("S First", "K Bowl", "T Second", 6), ball("T Second", "K Bowl", "S First", 0, wickets=[out("T Second", "bowled")])], super_over=True),
        innings(KKR, [ball("U Bat", "R Quick", "V Bat", 4)], super_over=True),
    ],
    outcome={"result": "tie", "eliminator": RCB}, season="2012", dates=["2012-04-14"],
)

NO_RESULT = document(
    [KKR, DD],
    [innings(KKR, [ball("U Bat", "B Partner", "V Bat", 0)])],
    outcome={"result": "no result"}, season="2013", dates=["2013-04-14"],
    players={KKR: ["U Bat"], DD: []}, people={},
)

TEST = document(
    ["India", "Australia"],
    [
        innings("India", [ball("I One", "X Bowl", "I Two", 4)], declared=True),
        innings("Australia", [ball("X Bowl", "I Bowl", "Y Bat", 0, wickets=[out("X Bowl", "lbw")],
                                  review={"by": "Australia", "decision": "struck down", "umpires_call": True})]),
        innings("Australia", [ball("Y Bat", "I Bowl", "X Bowl", 2)], penalty_runs={"pre": 5}),
        {"team": "India", "forfeited": True},
    ],
    match_type="Test", outcome={"result": "draw"}, event=None, season="2012/13", dates=["2012-11-30", "2012-12-01"],
)

ODD_WICKETS = document(
    [CSK, KKR],
    [innings(CSK, [
        ball("F Chase", "K Bowl", "G Other", 0, wickets=[out("F Chase", "retired hurt")]),
        ball("H Last", "K Bowl", "G Other", 0, wickets=[out("H Last", "obstructing the field"), out("G Other", "run out", "Al Keeper", "U Bat")]),
        ball("J Next", "K Bowl", "L Also", 0, wickets=[out("J Next", "run out", "Al", "Al Keeper")]),
        ball("L Also", "K Bowl", "M More", 0, wickets=[out("L Also", "retired out")]),
        ball("M More", "K Bowl", "N Nine", 0, wickets=[out("M More", "caught and bowled")]),
    ])],
    outcome={"winner": KKR, "by": {"runs": 3}}, season="2013", dates=["2013-05-01"],
)

# Nothing to route by; numbers as text, text as numbers, a float where an int belongs.
UNROUTED = document(
    ["P", "Q"], [innings("P", [ball("P1", "Q1", "P2", 1)])],
    dates=None, match_type=None, season=2014, overs="20", match_type_number=12.7,
    event=None, outcome={"winner": "P", "by": {"runs": "x"}},
)
UNROUTED["innings"][0]["overs"][0]["deliveries"][0]["runs"]["batter"] = "1"
del UNROUTED["innings"][0]["overs"][0]["over"]

EXCLUDED = document([DD, CSK], [innings(DD, [ball("A Opener", "C Seamer", "B Partner", 6)])],
                    season="2025", dates=["2025-05-08"])

ALL = {
    "t20/2012/1001": FIRST, "t20/2012/1002": CHASE, "t20/2012/1003": TIE, "t20/2013/1004": NO_RESULT,
    "test/2012/1005": TEST, "t20/2013/1006": ODD_WICKETS, "unknown/unknown/1008": UNROUTED,
    "t20/2025/1473495": EXCLUDED,
}


def write(root: Path, docs: dict) -> str:
    for key, doc in docs.items():
        kind, year, name = key.split("/")
        folder = root / f"match_type={kind}" / f"year={year}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps(doc, indent=1))
    return str(root)


def write_truncated(root: Path) -> None:
    text = json.dumps(FIRST)
    folder = root / "match_type=t20" / "year=2012"
    (folder / "1009.json").write_text(text[: len(text) // 2])

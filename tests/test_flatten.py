from overlake.plans.flatten import (
    flatten_deliveries,
    flatten_innings,
    flatten_matches,
    flatten_players,
)
from overlake.schemas import SILVER
from overlake.sources.raw import parse_documents, quarantine, read_raw, read_raw_texts, well_formed
from overlake.sources.raw import match_id_from
from tests import documents as docs
from tests.conftest import rows


def good(spark, raw):
    return well_formed(read_raw(spark, raw))


def one(df, match_id):
    return rows(df.filter(df.match_id == match_id))


def test_identity_and_partition_keys(spark, raw):
    found = {r.match_id: (r.match_type, r.year) for r in good(spark, raw).select("match_id", "match_type", "year").collect()}
    assert found["1001"] == ("t20", "2012")
    assert found["1005"] == ("test", "2012")
    assert found["1008"] == ("unknown", "unknown")
    assert len(found) == len(docs.ALL)


def test_truncated_document_is_set_aside(spark, raw):
    bad = quarantine(read_raw(spark, raw)).collect()
    assert [r.match_id for r in bad] == ["1009"]
    assert bad[0]._corrupt_record.startswith('{"meta"')


def test_parsing_a_column_equals_reading_files(spark, raw):
    texts = read_raw_texts(spark, raw)
    parsed = parse_documents(texts, "content", match_id_from("name"))
    assert [r.match_id for r in quarantine(parsed).collect()] == ["1009"]
    for flatten in (flatten_matches, flatten_innings, flatten_deliveries, flatten_players):
        assert rows(flatten(well_formed(parsed))) == rows(flatten(good(spark, raw)))


def test_leaving_parts_out_still_finds_broken_documents(spark, raw):
    parsed = parse_documents(read_raw_texts(spark, raw), "content", match_id_from("name"), ("meta", "info"))
    assert "innings" not in parsed.columns
    assert [r.match_id for r in quarantine(parsed).collect()] == ["1009"]


def test_schemas(spark, raw):
    for name, flatten in (("matches", flatten_matches), ("innings", flatten_innings),
                          ("deliveries", flatten_deliveries), ("players", flatten_players)):
        got = [(f.name, f.dataType) for f in flatten(good(spark, raw)).schema]
        assert got == [(f.name, f.dataType) for f in SILVER[name]]


def test_match_row(spark, raw):
    (m,) = one(flatten_matches(good(spark, raw)), "1001")
    assert (m["team_1"], m["team_2"], m["season"], m["match_date"]) == (docs.DD, docs.CSK, "2012", "2012-04-10")
    assert m["player_of_match"] == "A Opener, B Partner"
    assert (m["outcome_winner"], m["outcome_by_runs"], m["event_match_number"], m["revision"]) == (docs.DD, 5, 7, 1)
    assert m["toss_uncontested"] is None and m["outcome_by_wickets"] is None


def test_odd_leaves(spark, raw):
    (m,) = one(flatten_matches(good(spark, raw)), "1008")
    assert (m["season"], m["overs"], m["match_type_number"], m["outcome_by_runs"]) == ("2014", 20, 12, None)
    assert (m["match_date"], m["player_of_match"], m["revision"]) == (None, None, 1)
    (d,) = one(flatten_deliveries(good(spark, raw)), "1008")
    assert (d["over_number"], d["ball_in_over"], d["runs_batter"]) == (0, 1, 1)


def test_innings_rows(spark, raw):
    a, b, c, d = sorted(one(flatten_innings(good(spark, raw)), "1005"), key=lambda r: r["innings_number"])
    assert [x["innings_number"] for x in (a, b, c, d)] == [1, 2, 3, 4]
    assert a["declared"] is True and b["declared"] is None
    assert c["penalty_runs_pre"] == 5 and c["penalty_runs_post"] is None
    assert d["forfeited"] is True
    (first, second) = sorted(one(flatten_innings(good(spark, raw)), "1002"), key=lambda r: r["innings_number"])
    assert (second["target_runs"], second["target_overs"], first["target_runs"]) == (9, 20.0, None)


def test_delivery_rows(spark, raw):
    balls = {(r["innings_number"], r["over_number"], r["ball_in_over"]): r
             for r in one(flatten_deliveries(good(spark, raw)), "1001")}
    assert len(balls) == 13
    wide, wicket = balls[1, 0, 3], balls[1, 0, 4]
    assert (wide["extras_wides"], wide["runs_extras"], wide["runs_total"], wide["extras_byes"]) == (1, 1, 1, 0)
    assert (wicket["is_wicket"], wicket["wicket_count"], wicket["wicket_kind"]) == (True, 1, "caught")
    assert wicket["wicket_fielders"] == "Al Keeper" and wicket["wicket_fielders_arr"] == ["Al Keeper"]
    assert wide["is_wicket"] is False and wide["wicket_fielders"] is None
    assert balls[2, 0, 1]["runs_non_boundary"] is True and balls[1, 0, 1]["runs_non_boundary"] is None


def test_two_wickets_on_a_ball(spark, raw):
    (_, second, *_) = sorted(one(flatten_deliveries(good(spark, raw)), "1006"), key=lambda r: r["ball_in_over"])
    assert (second["wicket_count"], second["wicket_kind"], second["wicket_player_out"]) == (2, "obstructing the field", "H Last")


def test_review(spark, raw):
    (r,) = [x for x in one(flatten_deliveries(good(spark, raw)), "1005") if x["innings_number"] == 2]
    assert (r["review_by"], r["review_decision"], r["review_umpires_call"]) == ("Australia", "struck down", True)


def test_players(spark, raw):
    found = {r["player_name"]: (r["team"], r["cricsheet_id"]) for r in one(flatten_players(good(spark, raw)), "1001")}
    assert len(found) == 7
    assert found["A Opener"] == (docs.DD, "id-a") and found["D Late"] == (docs.DD, None)
    assert [r["player_name"] for r in one(flatten_players(good(spark, raw)), "1004")] == ["U Bat"]

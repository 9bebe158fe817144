from pyspark.sql import functions as F

from overlake.operators import (
    accepted_values,
    canonicalize,
    classify_revisions,
    dedupe,
    latest_by,
    mode_of,
    not_null,
    null_counts,
    reconcile,
    relationships,
    rule,
    top_k_share,
    top_n,
    unique,
    upsert_by_revision,
)
from tests.conftest import rows


def test_latest_by(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", None, "z")], "k string, v int, p string")
    found = rows(latest_by(df, ["k"], ["v DESC NULLS LAST"]))
    assert [(r["k"], r["p"]) for r in found] == [("a", "y"), ("b", "z")]


def test_dedupe_does_not_depend_on_arrival(spark):
    data = [("a", i % 7, f"p{i}") for i in range(60)]
    picks = {
        tuple(dedupe(spark.createDataFrame(d, "k string, v int, p string").repartition(n), ["k"]).first())
        for n, d in ((1, data), (5, data[::-1]), (9, sorted(data, key=lambda x: x[2])))
    }
    assert picks == {("a", 0, "p0")}


def test_hot_key_is_cut_before_the_exchange(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    for one, cut in ((dedupe(df, ["k"], ["id DESC"]), "WindowGroupLimit"), (dedupe(df, ["k"]), "partial_min")):
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert cut in plan[plan.index("Exchange"):]


def test_dedupe_takes_the_least_row_nulls_last(spark):
    data = [("a", None, 1), ("a", 2, 9), ("a", 2, None), ("b", None, None), (None, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(data, "k string, x int, y int")
    expected = {("a", 2, 9), ("b", None, None), (None, 1, 1)}
    assert {tuple(r) for r in dedupe(df, ["k"]).collect()} == expected
    assert dedupe(df, ["k"]).columns == df.columns


def test_placed_rows_are_sorted_only_behind_the_exchange(spark):
    data = [(k, i % 3, f"p{i % 4}", None if i % 5 else i) for i in range(40) for k in ("a", "b", None)] * 2
    df = spark.createDataFrame(data, "k string, n int, p string, x int")
    plain, placed = dedupe(df, ["k", "n"]), dedupe(df, ["k", "n"], place=["k"])
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Sort" not in text[text.index("Exchange"):]
    assert rows(placed) == rows(plain) and placed.count() == 9


def test_upsert_counts_and_result(spark):
    schema = "match_id string, revision int, payload string"
    current = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), ("c", 1, "old")], schema)
    incoming = spark.createDataFrame([("a", 2, "new"), ("b", 2, "same"), ("d", 1, "new"), ("d", 3, "newer")], schema)
    merged, stats = upsert_by_revision(current, incoming)
    assert {r["match_id"]: (r["revision"], r["payload"]) for r in rows(merged)} == {
        "a": (2, "new"), "b": (2, "old"), "c": (1, "old"), "d": (3, "newer")}
    assert {r["status"]: r["matches"] for r in rows(stats)} == {"new": 1, "updated": 1, "skipped": 1}
    again, stats = upsert_by_revision(merged, incoming)
    assert rows(again) == rows(merged)
    assert {r["status"]: r["matches"] for r in rows(stats)} == {"skipped": 3}


def test_missing_revision_counts_as_one(spark):
    index = spark.createDataFrame([("a", 1)], "match_id string, revision int")
    incoming = spark.createDataFrame([("a", None), ("b", None)], "match_id string, revision int")
    assert {r["match_id"]: r["status"] for r in rows(classify_revisions(index, incoming))} == {"a": "skipped", "b": "new"}


def test_canonicalize(spark):
    df = spark.createDataFrame([("x", "c1"), ("y", "c2"), (None, "c3")], "name string, city string")
    mapping = spark.createDataFrame([("x", "X", None)], "raw string, canon string, town string")
    found = rows(canonicalize(df, "name", mapping, "raw", {"name": "canon", "city": "town"}))
    assert [(r["name"], r["city"]) for r in found] == [("X", "c1"), ("y", "c2"), (None, "c3")]


def test_top_n_and_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 9)], "k string, v int")
    order = [F.desc_nulls_last("v"), F.asc_nulls_last("k")]
    assert [r.k for r in top_n(df, order, 3).collect()] == ["d", "a", "b"]
    assert [r.k for r in top_n(df, [F.asc_nulls_last("v"), F.asc("k")], None).collect()] == ["a", "b", "d", "c"]


def test_top_k_share(spark):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", 3), ("g", "c", 2), ("h", "a", 0)], "g string, e string, v int")
    first, second = rows(top_k_share(df, "g", "e", "v", 2), "g")
    assert (first["total"], first["top"], first["pct"], first["names"]) == (10, 8, 80.0, "a (5), b (3)")
    assert second["pct"] is None


def test_mode(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "z")], "k int, v string")
    assert [(r["k"], r["v"]) for r in rows(mode_of(df, ["k"], "v"))] == [(1, "a"), (2, "z")]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    assert not_null(df, ["k", "v"]).count() == 2
    assert {r["column_name"]: r["failures"] for r in rows(null_counts(df, ["k", "v"]))} == {"k": 2, "v": 0}
    assert [(r["k"], r["occurrences"]) for r in rows(unique(df, "k"))] == [("a", 2)]
    assert unique(df, ["k", "v"]).count() == 0
    assert unique(df, F.concat_ws("|", "k", F.lit("x"))).first()["occurrences"] == 2
    assert accepted_values(df, "k", ["b"]).count() == 2
    parent = spark.createDataFrame([("b",)], "k string")
    assert relationships(df, parent, "k").count() == 2
    assert [r["v"] for r in rows(rule(df, F.col("v") < 3))] == [3, 4]


def test_reconcile(spark):
    actual = spark.createDataFrame([("a", 10, 1), ("b", 5, 0), ("c", 7, 7)], "player string, runs long, hundreds long")
    expected = spark.createDataFrame([("a", 10, 1, "x"), ("b", 6, 0, "y"), ("c", None, None, "z")],
                                     "player string, runs long, hundreds long, note string")
    found = {r["player"]: r for r in rows(reconcile(actual, expected, "player", ["runs", "hundreds"]))}
    assert set(found) == {"a", "b"}
    assert (found["a"]["status"], found["a"]["runs_diff"]) == ("OK", 0)
    assert (found["b"]["status"], found["b"]["runs_diff"], found["b"]["expected_runs"]) == ("MISMATCH", -1, 6)

"""Rules counted while tables are written, against the same rules counted by reading the tables."""

from pyspark.sql import functions as F

from overlake import MatchTables, Seeds, Silver
from overlake.plans.catalogue import audit
from overlake.plans.ingest import transform
from overlake.plans.rules import REQUIRED, row_conditions
from tests import documents as docs
from tests.conftest import rows

#: Checked tables that are stored themselves; batting innings are read from the participation table.
STORED = [name for name in REQUIRED if name != "batting_innings"]


def damaged(silver: Silver, where: str) -> Silver:
    """Balls of some matches without a batter or with runs that do not add up, a match with a foreign winner."""
    balls = silver.deliveries.withColumns({
        "batter": F.expr(f"CASE WHEN {where} AND ball_in_over = 1 THEN NULL ELSE batter END"),
        "runs_total": F.expr(f"CASE WHEN {where} AND ball_in_over = 2 THEN runs_total + 1 ELSE runs_total END"),
    })
    matches = silver.matches.withColumn("outcome_winner", F.expr(f"CASE WHEN {where} THEN 'Nobody' ELSE outcome_winner END"))
    return Silver(matches, silver.innings, balls, silver.players)


def scanned(tables):
    """The report of tables that know nothing of how they were written."""
    class Plain:
        def __getattr__(self, name):
            if name == "broken_rows":
                raise AttributeError(name)
            return getattr(tables, name)

    return rows(audit.check_report(Plain()))


def report(tables):
    return rows(audit.check_report(tables))


def failures(found, table):
    return {f"{r['check']}|{r['column']}": r["failures"] for r in found if r["table"] == table and r["failures"]}


def test_counts_follow_the_store(spark, raw, tmp_path):
    silver, store = str(tmp_path / "silver"), str(tmp_path / "gold")
    transform(spark, raw, silver, "full")
    seeds = Seeds.standard(spark)
    first = MatchTables(Silver.read(spark, silver), seeds, store).build()
    for name in STORED:
        assert set(first.broken_rows(name)) == set(row_conditions(name)), name
    assert report(first) == scanned(first)
    assert MatchTables.load(spark, store)._broken == first._broken
    # A correction that brings failures into a folder: the others had none, so the sum is known.
    second = MatchTables.refresh(damaged(Silver.read(spark, silver), "match_type = 't20' AND year = '2012'"), seeds, store)
    assert second._touched == [("t20", 2012)]
    found = report(second)
    assert found == scanned(second)
    assert failures(found, "ball_by_ball")["rule|runs_total"] == second.broken_rows("ball_by_ball")["rule|runs_total"] > 0
    assert failures(found, "stg_deliveries")["not_null|batter"] > 0 and failures(found, "match_results")["rule|outcome_winner"] > 0
    # Another folder changes while the first has failures: only reading tells how many there are now.
    later = docs.write(tmp_path / "later", {"t20/2012/1001": docs.FIRST_CORRECTED})
    transform(spark, later, silver, "incremental")
    third = MatchTables.refresh(damaged(Silver.read(spark, silver), "match_id = '1006'"), seeds, store)
    assert "rule|runs_total" not in third.broken_rows("ball_by_ball")
    assert "not_null|match_id" in third.broken_rows("ball_by_ball")
    assert report(third) == scanned(third)
    assert report(MatchTables.load(spark, store)) == report(third)


def test_known_rules_need_no_scan(spark, ingested, tmp_path):
    tables = MatchTables(Silver.read(spark, ingested[0]), Seeds.standard(spark), str(tmp_path / "gold")).build()
    text = audit.check_report(tables)._jdf.queryExecution().executedPlan().toString()
    assert "/ball_by_ball" not in text and "/bowling_innings" not in text
    # Balls are read for their match alone.
    assert "ReadSchema: struct<match_id:string>" in text and "batter" not in text


def test_empty_tables_are_counted(spark, ingested, tmp_path):
    silver = Silver.read(spark, ingested[0])
    none = Silver(*(df.filter("match_id = 'none'") for df in (silver.matches, silver.innings, silver.deliveries, silver.players)))
    tables = MatchTables(none, Seeds.standard(spark), str(tmp_path / "gold")).build()
    assert set(tables.broken_rows("ball_by_ball").values()) <= {0}
    assert not any(r["failures"] for r in report(tables))


def test_tables_without_a_store_are_read(spark, ingested):
    plans = MatchTables(Silver.read(spark, ingested[0]), Seeds.standard(spark))
    assert plans.broken_rows("ball_by_ball") == {}
    assert report(plans) == scanned(plans)

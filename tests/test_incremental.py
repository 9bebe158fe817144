"""A store brought up to date equals one built from scratch, and only what changed is read and written."""

import re

import pytest

from overlake import MatchTables, Seeds, Silver
from overlake.plans import tables as stored
from overlake.plans.ingest import transform
from overlake.plans.tables import changed_folders
from overlake.sources.files import Conflict, folder_name
from overlake.workloads import _refreshed, match_tables
from tests import documents as docs
from tests.conftest import SF, rows

NAMES = list(stored._KEPT.values())


def equal(a, b):
    for name in NAMES:
        x, y = getattr(a, name), getattr(b, name)
        assert rows(x.select(*sorted(y.columns))) == rows(y.select(*sorted(y.columns))), name


def files(store):
    return {str(p): p.stat().st_mtime_ns for p in store.rglob("*.parquet")}


@pytest.fixture
def loaded(spark, raw, tmp_path):
    """Silver, and a store built from it."""
    silver, store = str(tmp_path / "silver"), tmp_path / "gold"
    transform(spark, raw, silver, "full")
    MatchTables(Silver.read(spark, silver), Seeds.standard(spark), str(store)).build()
    return silver, store


def test_a_corrected_match_rewrites_its_folder_only(spark, loaded, tmp_path):
    silver, store = loaded
    before = files(store)
    later = docs.write(tmp_path / "later", {"t20/2012/1001": docs.FIRST_CORRECTED})
    transform(spark, later, silver, "incremental")
    now = Silver.read(spark, silver)
    after = MatchTables.refresh(now, Seeds.standard(spark), str(store))
    assert after._touched == [("t20", 2012)]
    equal(after, MatchTables(now, Seeds.standard(spark), str(tmp_path / "full")).build())
    equal(MatchTables.load(spark, str(store)), after)
    # Nothing else was written in any folder, and nothing else was opened.
    new = set(files(store)) - set(before)
    assert new and all("match_type=t20/year=2012/" in f for f in new if "year=" in f)
    for name, source in (("deliveries", now.deliveries), ("innings", now.innings), ("players", now.players)):
        text = after._changed(source)._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
        assert "t20" in filters and "year" in filters, name
    for table in (after.balls, after.overs, after.batting, after.stg_deliveries):
        text = after._changed(table)._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
        assert "t20" in filters and "2012" in filters
    # The folders read are those of the correction, whatever else the store has.
    opened = {re.search("match_type=[^/]*/year=[^/]*", f).group() for f in after.batting_parts.inputFiles()}
    assert len(opened) > 1


def test_new_removed_and_moved_matches(spark, loaded, tmp_path):
    silver, store = loaded
    now = Silver.read(spark, silver)

    def other(df):
        kept = df.filter("match_id <> '1002'")
        moved = df.filter("match_id = '1005'").selectExpr(
            *[{"year": "'2014' AS year", "revision": "cast(7 AS int) AS revision"}.get(c, c) for c in df.columns]
        )
        return kept.unionByName(moved)

    changed = Silver(*[other(df) for df in (now.matches, now.innings, now.deliveries, now.players)])
    after = MatchTables.refresh(changed, Seeds.standard(spark), str(store))
    assert ("test", 2014) in after._touched and ("t20", 2012) in after._touched and ("test", 2012) in after._touched
    equal(after, MatchTables(changed, Seeds.standard(spark), str(tmp_path / "full")).build())
    assert after.balls.filter("match_id = '1002'").isEmpty() and after.stg_deliveries.filter("year = 2014").count() > 0
    # Back again; the year that only the moved match had is gone.
    again = MatchTables.refresh(now, Seeds.standard(spark), str(store))
    equal(again, MatchTables(now, Seeds.standard(spark), str(tmp_path / "first")).build())
    assert not any("year=2014" in place for places in again._placed.values() for place in places)


def test_nothing_changed_writes_nothing(spark, loaded):
    silver, store = loaded
    before = files(store)
    same = MatchTables.refresh(Silver.read(spark, silver), Seeds.standard(spark), str(store))
    assert files(store) == before and same.balls.count() > 0


def test_a_changed_seed_builds_everything(spark, loaded):
    silver, store = loaded
    seeds = Seeds.standard(spark)
    renamed = Seeds(seeds.team_map.filter("canonical_name <> 'Delhi Capitals'"), seeds.venue_map, seeds.excluded)
    after = MatchTables.refresh(Silver.read(spark, silver), renamed, str(store))
    assert after._touched is None
    assert after.balls.filter("batting_team = 'Delhi Daredevils'").count() > 0


def test_a_refresh_that_ends_early_changes_nothing(spark, loaded, tmp_path, monkeypatch):
    silver, store = loaded
    before = {name: rows(getattr(MatchTables.load(spark, str(store)), name)) for name in NAMES}
    later = docs.write(tmp_path / "later", {"t20/2012/1001": docs.FIRST_CORRECTED})
    transform(spark, later, silver, "incremental")
    now, seeds = Silver.read(spark, silver), Seeds.standard(spark)
    own = MatchTables._write
    for lost in ("balls", "dim_players", "batting_parts"):
        table = next(k for k, v in stored._KEPT.items() if v == lost)

        def ending(self, name, df, table=table):
            if name == table:
                raise RuntimeError("ended")
            return own(self, name, df)

        monkeypatch.setattr(MatchTables, "_write", ending)
        with pytest.raises(RuntimeError):
            MatchTables.refresh(now, seeds, str(store))
        monkeypatch.setattr(MatchTables, "_write", own)
        held = MatchTables.load(spark, str(store))
        assert {name: rows(getattr(held, name)) for name in NAMES} == before
    after = MatchTables.refresh(now, seeds, str(store))
    equal(after, MatchTables(now, seeds, str(tmp_path / "full")).build())
    # What the lost runs wrote is gone.
    kept = {v for placed in after._placed.values() for v in placed.values()}
    on_disk = {p.name.partition("=")[2] for p in store.rglob("match_type=t20/year=2012/v=*")}
    assert after._version in kept and len(on_disk) == 2


def test_two_writers(spark, loaded):
    silver, store = loaded
    now, seeds = Silver.read(spark, silver), Seeds.standard(spark)
    slow = MatchTables(now, seeds, str(store))
    slow._before = (0, {})
    MatchTables(now, seeds, str(store)).build()
    with pytest.raises(Conflict):
        slow.build()


def test_careers_move_no_player_matches(spark):
    t = match_tables(spark, SF)
    from overlake.plans import marts

    text = marts.batting_parts(t.batting)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "match_id" not in re.search(r"hashpartitioning\((.*?)\)", text).group(1)
    merged = marts.batting_career(t.batting_parts)._jdf.queryExecution().executedPlan().toString()
    assert "batting_parts" in merged and "participation" not in merged


def test_refreshed_driver_tables(spark):
    t = _refreshed(spark, SF)
    places = {("t20", 2011), ("it20", 2011)}
    assert t._touched is not None and len(t._touched) <= 3 and places & set(t._touched)


def test_changed_folders(spark):
    schema = "match_id string, match_type string, year int, x int"
    before = spark.createDataFrame([("1", "a", 1, 1), ("2", "a", 2, 1), ("3", "b", 1, None), ("4", "b", 2, 1)], schema)
    after = spark.createDataFrame([("1", "a", 1, 1), ("2", "c", None, 1), ("3", "b", 1, None), ("5", "d", 1, 1)], schema)
    assert sorted(changed_folders(before, after), key=repr) == [("a", 2), ("b", 2), ("c", None), ("d", 1)]


def test_folder_names(spark, tmp_path):
    odd = [("a/b", 1), ("50%", 2), ("x=y:z", None), ("ü ß", 3), (None, 4), ("q?[\\]^{", 5)]
    frame = spark.createDataFrame([(t, y, 1) for t, y in odd], "match_type string, year int, x int")
    frame.write.partitionBy("match_type", "year").parquet(str(tmp_path / "t"))
    made = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "t").glob("match_type=*/year=*")}
    assert made == {folder_name(t, y) for t, y in odd}

import json
import os
import time
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from overlake.plans.flatten import flatten_deliveries
from overlake.plans.ingest import transform
from overlake.schemas import SILVER
from overlake.sources import (
    BronzeStore,
    adopt_silver,
    bronze_rows,
    explode_archives,
    partition_inventory,
    publish,
    publish_models,
    register_views,
    read_raw,
    read_raw_texts,
    read_seed,
    read_silver,
    well_formed,
    write_silver,
)
from overlake.sources.archives import member_stem
from overlake.sources.bronze import taken_rows
from overlake.sources.seeds import SEED_ROWS
from overlake.streaming import ingest_available
from tests import documents as docs
from tests.conftest import rows


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("a/11.json", '{"x": 1}')
        z.writestr("__index.json", "{}")
        z.writestr("README.txt", "text")
        z.writestr("12.json", b"\xff\xfe\x00bad")
    (tmp_path / "two.zip").write_bytes(b"not a zip")
    found = rows(explode_archives(spark, str(tmp_path)).withColumn("stem", member_stem()))
    good = [r for r in found if r["error"] is None]
    assert [(r["stem"], r["content"]) for r in good] == [("11", '{"x": 1}')]
    assert len(found) == 3 and any(r["name"] == "12.json" for r in found)


def test_an_archive_beyond_two_gibibytes(spark, tmp_path):
    """The archive's members lie behind a hole of 2.5 GiB; no task could hold it."""
    from pyspark.sql import functions as F

    path = tmp_path / "large archive.zip"
    with open(path, "wb") as f:
        f.truncate(5 << 29)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as z:
        for i in range(80):
            z.writestr(f"{i}.json", json.dumps({"id": i, "text": "x" * 500}))
    found = explode_archives(spark, str(tmp_path), range_bytes=1 << 11).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(int(member.split(".")[0]) for member in (r["name"] for r in found)) == list(range(80))
    assert all(r["error"] is None and json.loads(r["content"])["text"] == "x" * 500 for r in found)
    assert len({r["task"] for r in found}) > 1


def test_ranges_are_read_a_little_at_a_time(tmp_path, monkeypatch):
    """Reading members never asks for more than a range's bytes, nor for bytes twice."""
    from types import SimpleNamespace

    from overlake.sources import archives

    path = tmp_path / "one.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(50):
            z.writestr(f"{i}.json" if i != 20 else "__big.json", "y" * (1000 if i != 20 else 100_000))
    monkeypatch.setattr(archives, "READ_BYTES", 5_000)
    asked = []

    class Counting:
        def __init__(self, name):
            self.file = open(name, "rb")

        def seek(self, *at):
            return self.file.seek(*at)

        def read(self, n=-1):
            asked.append(n)
            return self.file.read(n)

        def close(self):
            self.file.close()

    columns = [c.split()[0] for c in archives._PLACED.split(", ")]
    rows = [SimpleNamespace(**dict(zip(columns, r, strict=True))) for r in archives.placed_members(str(path), lambda p: open(p, "rb"))]
    assert len(rows) == 49 and [r.start for r in rows] == sorted(r.start for r in rows)
    found = list(archives.read_members(iter(rows), Counting))
    assert [(r[1], r[3]) for r in found] == [(m.name, None) for m in rows] and all(r[2] == "y" * 1000 for r in found)
    assert max(asked) <= 5_000 and len(asked) >= 10 and sum(asked) < 60_000
    # An archive that has gone meanwhile is one error per member.
    path.unlink()
    gone = list(archives.read_members(iter(rows), Counting))
    assert len(gone) == 49 and all("FileNotFoundError" in r[3] for r in gone)


def test_archive_to_silver(spark, tmp_path):
    from overlake.sources import parse_documents

    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        for key, doc in docs.ALL.items():
            z.writestr(key.split("/")[-1] + ".json", json.dumps(doc))
    members = explode_archives(spark, str(tmp_path))
    parsed = well_formed(parse_documents(members, "content", member_stem()))
    assert parsed.count() == len(docs.ALL)


def test_recent_files_only(spark, tmp_path):
    docs.write(tmp_path, docs.ALL)
    old = tmp_path / "match_type=t20/year=2012/1001.json"
    past = time.time() - 5 * 86400
    os.utime(old, (past, past))
    assert read_raw(spark, str(tmp_path)).count() == len(docs.ALL)
    recent = {r.match_id for r in read_raw(spark, str(tmp_path), since_days=2).select("match_id").collect()}
    assert len(recent) == len(docs.ALL) - 1 and "1001" not in recent
    assert read_raw(spark, str(tmp_path), since_days=30).count() == len(docs.ALL)


def test_silver_layout_and_types(spark, ingested):
    root, _ = ingested
    assert os.path.isdir(f"{root}/deliveries/match_type=t20/year=2012")
    assert os.path.isdir(f"{root}/matches/match_type=unknown/year=unknown")
    for name, schema in SILVER.items():
        df = read_silver(spark, root, name)
        assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in schema}
    # Both revisions are in silver; staging picks.
    assert read_silver(spark, root, "matches").filter("match_id = '1001'").count() == 2
    # A column without values keeps its type.
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{root}/deliveries") for f in fs if f.endswith(".parquet")]
    for f in files:
        meta = pq.ParquetFile(f)
        assert str(meta.schema_arrow.field("review_umpires_call").type) == "bool"
        assert meta.metadata.row_group(0).column(0).compression == "ZSTD"


def test_adopting_files_with_inferred_types(spark, tmp_path):
    def put(**columns):
        pq.write_to_dataset(pa.table(columns), tmp_path / "innings", partition_cols=["match_type", "year"])

    put(match_id=["1", "1"], match_type=["t20", "t20"], year=["2012", "unknown"], innings_number=[1, 2],
        batting_team=["A", "B"], declared=pa.nulls(2), super_over=pa.array([None, True]),
        target_runs=pa.nulls(2), target_overs=pa.array([20.0, None]), penalty_runs_post=pa.nulls(2))
    put(match_id=["2"], match_type=["odi"], year=["2013"], innings_number=[1], batting_team=["A"],
        declared=[True], super_over=pa.nulls(1), target_runs=[7], target_overs=[50], penalty_runs_post=[5])
    adopted = adopt_silver(spark, str(tmp_path), "innings")
    assert adopted.schema == SILVER["innings"]
    write_silver(adopted, str(tmp_path / "ours"), "innings")
    found = {(r.match_id, r.innings_number): r for r in read_silver(spark, str(tmp_path / "ours"), "innings").collect()}
    assert (found["1", 1].year, found["1", 2].year, found["2", 1].match_type) == ("2012", "unknown", "odi")
    assert found["1", 2].super_over is True and found["1", 1].declared is None
    assert (found["2", 1].target_overs, found["1", 1].target_overs, found["2", 1].penalty_runs_post) == (50.0, 20.0, 5)
    assert found["1", 1].revision is None


def test_full_load_replaces(spark, raw, tmp_path):
    root = str(tmp_path / "silver")
    transform(spark, raw, root, "full")
    transform(spark, raw, root, "full")
    once = read_silver(spark, root, "matches").count()
    transform(spark, raw, root, "incremental", since_days=2)
    assert (once, read_silver(spark, root, "matches").count()) == (len(docs.ALL), len(docs.ALL))


def test_file_size_limit(spark, tmp_path, raw):
    balls = flatten_deliveries(well_formed(read_raw(spark, raw)))
    write_silver(balls, str(tmp_path), "deliveries", max_records_per_file=5)
    files = list(tmp_path.rglob("*.parquet"))
    assert max(pq.ParquetFile(f).metadata.num_rows for f in files) <= 5


def test_seeds(spark, tmp_path):
    for name, expected in SEED_ROWS.items():
        assert sorted(map(tuple, read_seed(spark, name).collect())) == sorted(expected)
    path = tmp_path / "excluded.csv"
    path.write_text("match_id,reason\n0042,rain\n")
    assert read_seed(spark, "excluded_matches", str(path)).first().match_id == "0042"


def test_inventory(spark, raw):
    found = [tuple(r) for r in partition_inventory(spark, raw).collect()]
    assert found[0] == (None, None, len(docs.ALL) + 1)
    assert ("t20", "2012", 4) in found and ("unknown", "unknown", 1) in found
    assert found[1:] == sorted(found[1:])


def counted(report):
    out = {}
    for r in rows(report):
        out[r["status"]] = out.get(r["status"], 0) + r["matches"]
    return out


def test_bronze_is_idempotent(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    assert store.current().count() == 0 and store.index().count() == 0
    raw = docs.write(tmp_path / "raw", docs.ALL)
    docs.write_truncated(tmp_path / "raw")
    batch = bronze_rows(read_raw_texts(spark, raw))
    store.apply(batch, 0)
    n = len(docs.ALL)
    assert counted(store.stats(0)) == {"new": n, "unreadable": 1}
    assert ("t20", "2012") in {(r["match_type"], r["year"]) for r in rows(store.stats(0))}
    assert [r["match_id"] for r in rows(store.errors())] == ["1009"]
    store.apply(batch, 0)  # replayed
    assert store.current().count() == n and store.errors().count() == 1
    store.apply(batch, 1)  # sent again
    assert counted(store.stats(1)) == {"skipped": n, "unreadable": 1}
    later = docs.write(tmp_path / "later", {"t20/2012/1001": docs.FIRST_CORRECTED})
    store.apply(bronze_rows(read_raw_texts(spark, later)), 2)
    assert counted(store.stats(2)) == {"updated": 1}
    current = {r.match_id: (r.revision, r.match_type, r.year) for r in store.current().collect()}
    assert len(current) == n and current["1001"] == (2, "t20", "2012")
    first = next(p for p in (tmp_path / "bronze/documents").iterdir() if p.name.startswith(f"part={0:012d}-"))
    assert "match_type=t20" in {p.name for p in first.iterdir() if p.is_dir()}


def test_accepted_texts_are_exchanged_once(spark):
    schema = "match_id string, revision int, content string, h1 long, h2 long"
    texts = [("a", 1, "x", 5, 6), ("a", 2, "y", 7, 8), ("a", 2, "y", 7, 8), ("b", 1, "z", 9, 9), (None, 1, "n", 1, 1), ("c", 1, "w", 3, 4)]
    accepted = [("a", 2, 7, 8, "new"), ("b", 1, 9, 0, "new"), ("c", 1, 3, 4, "updated")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        taken = taken_rows(
            spark.createDataFrame(texts, schema), spark.createDataFrame(accepted, "match_id string, revision int, h1 long, h2 long, status string")
        )
        plan = taken._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # one for either side
    assert [(r["match_id"], r["content"], r["status"]) for r in rows(taken, "match_id")] == [("a", "y", "new"), ("c", "w", "updated")]


def test_bronze_refuses_a_number_with_other_content(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path / "bronze"))
    one = bronze_rows(spark.createDataFrame([("a.json", '{"meta":{"revision":1}}')], "name string, content string"))
    two = bronze_rows(spark.createDataFrame([("b.json", '{"meta":{"revision":1}}')], "name string, content string"))
    store.apply(one, 0)
    with pytest.raises(ValueError):
        store.apply(two, 0)
    store.apply(two, 0, "other")
    assert {r.match_id for r in store.current().collect()} == {"a", "b"}


def _versions(spark, *pairs):
    texts = [(f"{name}.json", f'{{"meta":{{"revision":{revision}}}}}') for name, revision in pairs]
    return bronze_rows(spark.createDataFrame(texts, "name string, content string"))


def _held(store):
    return {r.match_id: (r.revision, r.feed, r.batch) for r in store.current().collect()}


def test_bronze_index_is_folded_by_range(spark, tmp_path, monkeypatch):
    from overlake.sources import bronze

    monkeypatch.setattr(bronze, "FOLD", 3)
    store = BronzeStore(spark, str(tmp_path / "bronze"), ranges=4)
    for n in range(8):
        store.apply(_versions(spark, ("a", n + 1), (str(n), n + 1)), n)
    expected = {"a": (8, "main", 7)} | {str(n): (n + 1, "main", n) for n in range(8)}
    assert _held(store) == expected
    number, state = store._state()
    assert number == 7 and max(len(parts) for parts in state["index"].values()) <= 3
    # What was folded is gone from the disk, but for what the last record left for its readers.
    on_disk = {f"index/{p.parent.name}/{p.name}" for p in (tmp_path / "bronze/index").glob("part=*/range=*")}
    live = {f"index/part={p}/range={r}" for r, parts in state["index"].items() for p in parts}
    waiting = {g for g in state["gone"]}
    assert live <= on_disk and all(any(d == w or d.startswith(f"{w}/") for w in waiting) for d in on_disk - live)
    # Batches whose digest has left the record are still known.
    assert len(state["recent"]) < 3 and state["applied"]
    store.apply(_versions(spark, ("a", 1), ("0", 1)), 0)
    assert _held(store) == expected and store._state()[0] == 7
    with pytest.raises(ValueError):
        store.apply(_versions(spark, ("a", 9)), 1)


def test_a_batch_opens_only_its_ranges(spark, tmp_path, monkeypatch):
    store = BronzeStore(spark, str(tmp_path / "bronze"), ranges=16)
    store.apply(_versions(spark, *[(str(n), 1) for n in range(60)]), 0)
    state = store._state()[1]
    assert len(state["index"]) > 10
    one = store._index(state, ["3"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "range" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    files = {f for f in one.inputFiles()}
    assert 0 < one.count() < 20 and files
    read = store._read("match_id string, range int, part string", "index").filter("range = 3").select("match_id").count()
    assert read == one.count()
    # The batch asks for the ranges of its own matches.
    asked = []
    own = BronzeStore._index
    monkeypatch.setattr(BronzeStore, "_index", lambda self, s, ranges=None: asked.append(ranges) or own(self, s, ranges))
    store.apply(_versions(spark, ("7", 2)), 1)
    assert [len(r) for r in asked] == [1]


class _Ended(Exception):
    pass


class _EndingStore(BronzeStore):
    """Ends the run before its ``at``-th write."""

    at = -1

    def _about_to(self, write):
        self.seen = [*getattr(self, "seen", []), write]
        if len(self.seen) == self.at + 1:
            raise _Ended(write)


def test_a_batch_that_ends_anywhere_is_repeated_without_loss(spark, tmp_path, monkeypatch):
    from overlake.sources import bronze

    # The batch that ends folds the index and the table of batches as well.
    monkeypatch.setattr(bronze, "FOLD", 2)
    base, batch = _versions(spark, ("a", 1), ("b", 1)), _versions(spark, ("b", 2), ("c", 1), ("a", 1))
    expected = {"a": (1, "main", 0), "b": (2, "main", 1), "c": (1, "main", 1)}
    ended, at = [], 0
    while True:
        path = str(tmp_path / f"bronze-{at}")
        BronzeStore(spark, path, ranges=2).apply(base, 0)
        store = _EndingStore(spark, path)
        store.at = at
        try:
            store.apply(batch, 1)
            break
        except _Ended as err:
            ended.append(str(err))
        # Nothing or everything, then the rest.
        before = {"a": (1, "main", 0), "b": (1, "main", 0)}
        again = BronzeStore(spark, path)
        assert _held(again) == (expected if ended[-1] == "end" else before)
        again.apply(batch, 1)
        assert _held(again) == expected and counted(again.stats(1)) == {"new": 1, "updated": 1, "skipped": 1}
        again.apply(batch, 1)
        again.apply(_versions(spark, ("d", 1)), 2)
        assert _held(again) == expected | {"d": (1, "main", 2)}
        assert again.errors().count() == 0
        at += 1
    assert ended == ["documents", "errors", "report", "index", "applied", "cleaning", "state", "end"]


def test_a_second_writer_is_told_and_starts_again(spark, tmp_path):
    path = str(tmp_path / "bronze")
    BronzeStore(spark, path).apply(_versions(spark, ("a", 1)), 0)

    class Overtaken(BronzeStore):
        def _about_to(self, write):
            if write == "state" and not hasattr(self, "done"):
                self.done = True
                BronzeStore(spark, path).apply(_versions(spark, ("a", 3), ("b", 1)), 0, "other")

    Overtaken(spark, path).apply(_versions(spark, ("a", 2), ("c", 1)), 1)
    store = BronzeStore(spark, path)
    # The overtaken batch was classified again: its revision of a match is no news any more.
    assert _held(store) == {"a": (3, "other", 0), "b": (1, "other", 0), "c": (1, "main", 1)}
    assert counted(store.stats(1)) == {"new": 1, "skipped": 1}
    # The first attempt's folders are gone.
    assert len(list((tmp_path / "bronze/documents").glob("part=*"))) == 3


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "bronze")
    store = _EndingStore(spark, path)
    store.apply(_versions(spark, ("a", 1), ("x", 1)), 0)
    store.seen, store.at = [], 3
    with pytest.raises(_Ended):
        store.apply(_versions(spark, ("a", 2)), 1)
    store.at = -1
    for n in range(2, 7):
        store.apply(_versions(spark, ("a", n)), n)
    held = _held(store)
    deleted = store.vacuum()
    # The attempt that ended, and documents of which nothing is current.
    assert sum(d.startswith("documents/") for d in deleted) >= 2 and any(d.startswith("report/") for d in deleted)
    assert _held(store) == held == {"a": (6, "main", 6), "x": (1, "main", 0)}
    assert store.vacuum() == [] and counted(store.stats(3)) == {"updated": 1}


def test_a_stream_that_ends_anywhere_goes_on_without_loss(spark, tmp_path):
    schema, landing = "name string, content string", tmp_path / "landing"
    spark.createDataFrame([("a.json", '{"meta":{"revision":1}}'), ("b.json", "{")], schema).write.parquet(str(landing))
    for at in (0, 5, 6):
        store = _EndingStore(spark, str(tmp_path / f"bronze-{at}"))
        store.at = at

        def run():
            source = spark.readStream.schema(schema).parquet(str(landing))
            return ingest_available(source, store, str(tmp_path / f"progress-{at}"), bronze_rows)

        with pytest.raises(Exception, match="_Ended"):
            run()
        store.at = -1
        run()  # from its checkpoint, with the number it had
        assert _held(store) == {"a": (1, "stream", 0)} and store.errors().count() == 1


def test_one_scan_of_a_batch(spark, tmp_path):
    """A source that counts how often it is read is read once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    texts = spark.createDataFrame([(f"{i}.json", "{}") for i in range(10)], "name string, content string")
    BronzeStore(spark, str(tmp_path / "bronze")).apply(bronze_rows(texts.mapInPandas(count, texts.schema)), 0)
    assert seen.value == 10


def test_stream_equals_batches(spark, tmp_path):
    landing, store = tmp_path / "landing", BronzeStore(spark, str(tmp_path / "bronze"))
    schema = "name string, content string"

    def arrive(doc, n):
        landing.mkdir(exist_ok=True)
        spark.createDataFrame([("1001.json", json.dumps(doc))], schema).write.mode("append").parquet(str(landing))

    def run():
        source = spark.readStream.schema(schema).parquet(str(landing))
        return ingest_available(source, store, str(tmp_path / "progress"), bronze_rows)

    arrive(docs.FIRST_CORRECTED, 0)
    run()
    arrive(docs.FIRST, 1)  # a lower revision arriving late
    run()
    run()  # nothing new
    current = store.current().collect()
    assert [(r.match_id, r.revision) for r in current] == [("1001", 2)]
    assert counted(store.stats(1, "stream")) == {"skipped": 1}
    # A fresh checkpoint numbers from 0 again: refused under the same feed, kept apart under another.
    source = spark.readStream.schema(schema).parquet(str(landing))
    with pytest.raises(Exception, match="already stored"):
        ingest_available(source, store, str(tmp_path / "fresh"), bronze_rows)
    ingest_available(source, store, str(tmp_path / "another"), bronze_rows, "again")
    assert [(r.match_id, r.revision) for r in store.current().collect()] == [("1001", 2)]


def test_records(spark, tmp_path):
    from overlake.sources.files import Conflict, Folder, Records

    records = Records(Folder(spark, str(tmp_path / "f")), "state")
    assert records.latest({"n": 0}) == (-1, {"n": 0})
    for n in range(5):
        assert records.commit(n - 1, {"n": n}) == n
    assert records.latest({}) == (4, {"n": 4})
    with pytest.raises(Conflict):
        records.commit(3, {"n": 9})
    assert records.latest({}) == (4, {"n": 4})
    # Older records go; nothing half-written stays.
    assert sorted(p.name for p in (tmp_path / "f/state").iterdir() if not p.name.startswith(".")) == [f"{n:012d}" for n in (2, 3, 4)]


def test_publish(spark, tables, tmp_path):
    view = publish(tables.fct_deliveries, "marts", "fct_deliveries", as_view=True)
    assert view.count() == spark.table("marts_fct_deliveries").count() == tables.ball_by_ball.count()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    table = publish(tables.batting_career, "marts", "mart_batting_career", partition_by=["match_type"], sort_by=["player_name"])
    assert rows(table.select(*tables.batting_career.columns)) == rows(tables.batting_career)
    assert spark.sql("select count(*) from marts.mart_batting_career where match_type = 't20'").first()[0] > 0


def test_models_in_sql(spark, tables, tmp_path):
    names = register_views(tables)
    assert len(names) == 15
    found = spark.sql(
        "select player_name, total_runs from mart_batting_career where player_name = :p", args={"p": "S First"}
    ).collect()
    assert [r.total_runs for r in found] == [11]
    for layer in ("staging", "intermediate", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS t_{layer} LOCATION '{tmp_path}/{layer}'")
    published = publish_models(tables, "t_")
    assert len(published) == 12
    balls = spark.table("t_marts.fct_deliveries")
    assert balls.count() == tables.ball_by_ball.count()
    joined = spark.sql(
        """select m.season, sum(d.runs_total) as runs from t_marts.fct_deliveries d
           join t_marts.fct_match_results m using (match_id) where m.event_name ilike '%premier%'
           group by m.season order by m.season"""
    ).collect()
    assert [r.season for r in joined] == ["2012", "2013"]


def test_scratch_follows_the_session(spark):
    from types import SimpleNamespace

    from overlake.session import SCRATCH, scratch_dir

    def session(**conf):
        known = {"spark.sql.warehouse.dir": "/warehouse", **{k.replace("_", "."): v for k, v in conf.items()}}
        context = SimpleNamespace(applicationId="app-1", master="spark://host", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: known.get(k, d)))

    assert scratch_dir(session(spark_checkpoint_dir="/shared/area/")) == "/shared/area/overlake-app-1"
    assert scratch_dir(session()) == "/warehouse/_scratch/overlake-app-1"
    named = session(**{SCRATCH.replace(".", "_"): "/named"})
    assert scratch_dir(named) == "/named/overlake-app-1"
    assert scratch_dir(spark) == scratch_dir(spark)


def test_damaged_members_and_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    path = tmp_path / "one.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(60):
            z.writestr(f"m/{i}.json", json.dumps({"id": i, "text": "x" * 200}))
        z.writestr(zipfile.ZipInfo("m/stored.json"), "{}", zipfile.ZIP_STORED)
        z.writestr("m/other.json", "{}" * 50, zipfile.ZIP_BZIP2)
        entries = {e.filename: e for e in z.infolist()}
    blob = bytearray(path.read_bytes())
    blob[entries["m/3.json"].header_offset + 30 + len("m/3.json")] |= 6  # no such block type
    blob[entries["m/4.json"].header_offset] = 0  # no header
    blob[blob.rindex(b"m/5.json") - 46 + 8] |= 1  # encrypted
    path.write_bytes(bytes(blob))
    (tmp_path / "cut.zip").write_bytes(bytes(blob[: len(blob) // 2]))
    found = explode_archives(spark, str(tmp_path), 1 << 10).withColumn("task", F.spark_partition_id()).collect()
    bad = {r["name"]: r["error"] for r in found if r["error"] is not None}
    assert set(bad) == {"m/3.json", "m/4.json", "m/5.json", "m/other.json", None}
    assert "encrypted" in bad["m/5.json"] and "method" in bad["m/other.json"]
    assert {r["name"] for r in found if r["error"] is None} >= {"m/stored.json", "m/59.json"} and len(found) == 63
    assert len({r["task"] for r in found if r["archive"].endswith("one.zip")}) > 1


def test_repeated_incremental_load_adds_nothing(spark, raw, tmp_path):
    silver = str(tmp_path / "silver")
    transform(spark, raw, silver, "full")
    before = {t: read_silver(spark, silver, t).count() for t in SILVER}
    transform(spark, raw, silver, "incremental")
    assert {t: read_silver(spark, silver, t).count() for t in SILVER} == before


def test_a_file_marker_is_whole_or_absent(spark, tmp_path):
    from overlake.sources.files import Folder, newest

    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == [] and not folder.exists("a")
    assert folder.create("a", "one") and not folder.create("a", "two")
    assert folder.read("a") == "one" and folder.names() == ["a"]
    assert newest(["000002", "10", "x", "000010.part"]) == "10" and newest([]) is None

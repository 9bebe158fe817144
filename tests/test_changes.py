"""Streams of changes, and the ledger of files."""

import os
import time

from pyspark.sql import types as T

from overlake.plans.ingest import transform_unseen
from overlake.sources import FileLedger, read_silver
from overlake.streaming import changes_of, follow_changes
from tests import documents as docs

ITEM = T.StructType([T.StructField(c, T.StringType()) for c in ("ball", "runs")])
DOCUMENT = "match_id string, revision int, items string"


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def bring(self, *rows):
        """Documents arrive; the changes that the stream then has in all."""
        self.spark.createDataFrame(list(rows), DOCUMENT).coalesce(1).write.mode("append").parquet(f"{self.root}/landing")
        source = self.spark.readStream.schema(DOCUMENT).parquet(f"{self.root}/landing")
        before = self.held()
        follow_changes(source, ITEM, f"{self.root}/table", f"{self.root}/progress")
        after = self.held()
        for row in before:
            after.remove(row)
        return sorted(after)

    def held(self):
        try:
            return [tuple(r) for r in self.spark.read.parquet(f"{self.root}/table").collect()]
        except Exception:
            return []


def test_only_accepted_revisions_and_what_they_take_back(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    two = '[["1","4"],["2","0"]]'
    assert feed.bring(("a", 2, two), ("b", None, '[["1","1"]]')) == [
        ("a", 2, "1", "4", 1), ("a", 2, "2", "0", 1), ("b", 1, "1", "1", 1)]
    # Lower and equal revisions, late or repeated, say nothing; the state outlives the stream.
    assert feed.bring(("a", 1, '[["1","6"]]'), ("a", 2, '[["9","9"]]'), ("b", 1, '[["1","1"]]')) == []
    # A higher one: what it leaves as it was is no change.
    assert feed.bring(("a", 5, '[["1","4"],["2","1"],["3","2"]]')) == [
        ("a", 5, "2", "0", -1), ("a", 5, "2", "1", 1), ("a", 5, "3", "2", 1)]
    # Several at once: the highest; of equal ones always the same.
    assert feed.bring(("b", 3, '[["1","3"]]'), ("b", 2, '[["1","2"]]'), ("b", 3, '[["1","0"]]')) == [
        ("b", 3, "1", "0", 1), ("b", 3, "1", "1", -1)]
    # All items gone.
    assert feed.bring(("b", 4, "[]")) == [("b", 4, "1", "0", -1)]
    net = {}
    for match, _, ball, runs, change in feed.held():
        net[match, ball, runs] = net.get((match, ball, runs), 0) + change
    assert {k for k, n in net.items() if n} == {("a", "1", "4"), ("a", "2", "1"), ("a", "3", "2")}


def test_a_match_leaves_the_state_as_one_row(spark, tmp_path):
    """A row per change would be made in Python one by one; values may be missing or numbers."""
    spark.createDataFrame([], DOCUMENT).write.parquet(f"{tmp_path}/landing")
    stream = changes_of(spark.readStream.schema(DOCUMENT).parquet(f"{tmp_path}/landing"), ITEM)
    assert stream.columns == ["match_id", "revision", "ball", "runs", "change"]
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Generate inline(from_json(" in plan and "TransformWithState" in plan
    feed = Feed(spark, tmp_path / "feed")
    assert feed.bring(("a", 1, '[["1",null],["2",4],["2",4]]')) == [("a", 1, "1", None, 1), ("a", 1, "2", "4", 1)]


def test_files_that_arrive_late_are_loaded_once(spark, raw, tmp_path):
    folder, silver = tmp_path / "raw", str(tmp_path / "silver")
    first = {k: docs.ALL[k] for k in list(docs.ALL)[:4]}
    docs.write(folder, first)
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    assert transform_unseen(spark, str(folder), silver, ledger) == 4
    assert transform_unseen(spark, str(folder), silver, ledger) == 0
    # The others arrive with times long past.
    docs.write(folder, docs.ALL)
    for path in folder.rglob("*.json"):
        past = time.time() - 900 * 86400
        if not any(path.stem == k.split("/")[-1] for k in first):
            os.utime(path, (past, past))
    again = transform_unseen(spark, str(folder), silver, ledger)
    # A file written again has a new time; its match adds nothing.
    assert again >= len(docs.ALL) - 4
    assert transform_unseen(spark, str(folder), silver, ledger) == 0
    assert read_silver(spark, silver, "matches").count() == len(docs.ALL)
    assert ledger.held().count() >= len(docs.ALL)


def test_a_load_that_ends_early_is_repeated(spark, tmp_path, monkeypatch):
    import pytest

    from overlake.sources import ledger as module

    monkeypatch.setattr(module, "FOLD", 2)
    folder = tmp_path / "raw [odd]"
    folder.mkdir()
    ledger, loaded = FileLedger(spark, str(tmp_path / "ledger")), []
    for n in range(5):
        (folder / f"{n}.json").write_text("{}")

        def fails(paths):
            raise RuntimeError("ended")

        with pytest.raises(RuntimeError):
            ledger.take(str(folder).replace("[", "\\[").replace("]", "\\]"), fails)
        assert ledger.take(str(folder).replace("[", "\\[").replace("]", "\\]"), lambda paths: loaded.append(spark.read.text(paths).count())) == 1
    assert loaded == [1] * 5 and ledger.held().count() == 5
    assert len(ledger._records.latest({})[1]["parts"]) == 1
    # Of what was folded at most the last is still there.
    assert len(list((tmp_path / "ledger").glob("part-*"))) <= 3


"""Revisions of matches as a stream of changes.

Every document says what a match consists of.  Per match, a state keeps the highest revision
seen and its items, and what goes out are the items that a higher revision adds (``change`` 1)
and those that it takes back (``change`` -1); an item it leaves as it was is no change.  Lower
and equal revisions give nothing, however late they arrive and however often.  So the sum of
all changes is at any time the newest revision of every match, and whoever keeps sums per
player, over or season brings them up to date without reading the match again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGED = "match_id string, revision int, changes string"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Revisions(StatefulProcessor):
    """The state of one match: its revision, and its items as JSON, so that one call reads and one writes it."""

    def __init__(self, columns: Sequence[str]):
        self._columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", "revision int, items string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held.get()
        newest, items = (held[0], held[1]) if held is not None else (None, "[]")
        before = items
        for row in rows:
            revision, text = 1 if row["revision"] is None else row["revision"], row["items"]
            # Of equal revisions in one batch the smallest text counts, so the order of rows does not.
            if newest is None or revision > newest or (revision == newest and before is not items and text < items):
                newest, items = revision, text
        if items is before and held is not None:
            return
        self._held.update((newest, items))
        old, new = ({json.dumps(i) for i in json.loads(t)} for t in (before, items))
        changes = [(i, -1) for i in old - new] + [(i, 1) for i in new - old]
        if changes:
            # One row per match: a row per change would be made, checked and sent one by one.
            fields = [dict(zip(self._columns, json.loads(i), strict=True)) | {"change": change} for i, change in sorted(changes)]
            yield Row(match_id=key[0], revision=newest, changes=json.dumps(fields))

    def close(self) -> None:
        pass


def changes_of(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """A stream (match_id, revision, items) -> (match_id, revision, the fields of ``schema``, change).

    ``items`` is a JSON list of rows, each a list of the fields' values.  The state holds one
    document per match.
    """
    change = T.StructType([*schema.fields, T.StructField("change", T.IntegerType())])
    changed = documents.groupBy("match_id").transformWithState(
        _Revisions(schema.fieldNames()), outputStructType=_CHANGED, outputMode="append", timeMode="none"
    )
    return changed.select("match_id", "revision", F.inline(F.from_json("changes", T.ArrayType(change))))


def follow_changes(documents: DataFrame, schema: T.StructType, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the changes of all documents that the stream has by now to a Parquet table, then stops.

    The state store is RocksDB, which the operator needs; the setting is put back.
    """
    spark: SparkSession = documents.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            changes_of(documents, schema)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return query

"""New documents applied to the bronze layer as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from overlake.sources.bronze import BronzeStore


def ingest_available(
    source: DataFrame,
    store: BronzeStore,
    checkpoint: str,
    to_bronze: Callable[[DataFrame], DataFrame],
    feed: str = "stream",
) -> StreamingQuery:
    """Apply everything ``source`` has by now, then stop.

    ``source`` is a streaming frame and ``to_bronze`` turns a batch of it into bronze
    rows.  Progress is kept in ``checkpoint``; a batch run again after a failure keeps
    its number and changes nothing.  Lower or equal revisions that arrive late are
    skipped.  Every checkpoint needs a ``feed`` of its own: with a fresh one the numbers
    begin again, and the store refuses a number that holds something else.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.apply(to_bronze(batch), batch_id, feed)

    query = (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

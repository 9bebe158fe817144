"""Best-fit packing of documents into training sequences of several permitted lengths.

A document longer than the longest sequence is cut into pieces of that length; its remainder
and all shorter documents are packed.  In each shard, pieces are taken longest first.  A piece
goes into the open bin that it fills best; if none has room, a bin opens whose length costs
least for what it can be expected to hold: the piece and what smaller pieces still wait.  At
the end each bin shrinks to the shortest permitted length that holds its contents.

Pieces are dealt to shards of about ``SHARD`` by the hash of document and piece, so no task
holds more, and at most the last bins of a shard stay poorly filled.  Full pieces of the
longest length are bins of their own and travel nowhere.

Null and empty texts have no words, so no piece.  Rows that repeat a document are counted
before they are dealt and each is packed; pieces of one length are ties, which go by key, piece and
occurrence, null keys last.  An empty table gives no bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.tables import stored

#: Permitted sequence lengths, in tokens.
LENGTHS = (256, 512, 1024, 2048, 4096)
#: Pieces packed together in one task.
SHARD = 8_192
#: What a sequence costs besides its tokens, and the share of attention at the longest length.
PER_SEQUENCE = 16
ATTENTION = 0.25

#: The columns of a packed piece after the document's key, which keeps its type.
PACKED = (
    "piece int, occurrence long, first_token long, n_tokens int, shard long, bin long, bin_length int, bin_offset int"
)


def costs(lengths: Sequence[int]) -> np.ndarray:
    """Cost of a sequence of each length: its tokens, attention that grows with the square, and a fixed part."""
    own = np.asarray(lengths, float)
    return PER_SEQUENCE + own + ATTENTION * own**2 / own.max()


@dataclass
class Packing:
    """Bin of each piece and its place in the bin; final length of each bin."""

    bins: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray


def pack(sizes: np.ndarray, lengths: Sequence[int] = LENGTHS) -> Packing:
    """Packs ``sizes``, which must not grow along the array and not exceed the longest length."""
    permitted = np.array(sorted(lengths))
    cost = costs(permitted)
    waiting = np.concatenate([[0], np.cumsum(sizes[::-1])])  # tokens of the smallest pieces
    ascending = sizes[::-1]
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    capacity: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, chosen = rooms.pop(at)
        else:
            fits = np.flatnonzero(permitted >= size)
            spare = permitted[fits] - size
            # What still waits and fits into the spare room may fill it.
            behind = np.minimum(np.searchsorted(ascending, spare, "right"), len(sizes) - i - 1)
            held = size + np.minimum(spare, waiting[behind])
            chosen = len(filled)
            capacity.append(int(permitted[fits[np.argmin(cost[fits] / held)]]))
            filled.append(0)
            room = capacity[-1]
        bins[i], offsets[i] = chosen, filled[chosen]
        filled[chosen] += size
        if room > size:
            insort(rooms, (room - size, chosen))
    return Packing(bins, offsets, permitted[np.searchsorted(permitted, np.array(filled, np.int64))])


def words(text: str = "text") -> Column:
    """Words between white space: the default measure of a document's length."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")).cast("long")


def pieces(docs: DataFrame, n_tokens: Column, longest: int) -> DataFrame:
    """(doc_id, total, piece, occurrence, first_token, n_tokens): one row per piece of each document row.

    Rows that agree in key and length are one group with a count until here, so that many
    repeats of one document don't meet in one task.
    """
    counted = (
        docs.select("doc_id", n_tokens.alias("total"))
        .where("total > 0")
        .groupBy("doc_id", "total")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    one = counted.select(
        "doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("occurrence")
    )
    last = F.floor((F.col("total") - 1) / longest).cast("int")
    first = (F.col("piece") * F.lit(longest).cast("long")).alias("first_token")
    return one.select("doc_id", "total", "occurrence", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id",
        "total",
        "piece",
        "occurrence",
        first,
        F.least(F.lit(longest), F.col("total") - F.col("piece") * F.lit(longest).cast("long")).cast("int").alias("n_tokens"),
    )


def assign(
    docs: DataFrame, n_tokens: Column | None = None, lengths: Sequence[int] = LENGTHS, shard: int = SHARD
) -> DataFrame:
    """The bin of every piece: its document's ``doc_id``, of any type that groups and sorts, and ``PACKED``.

    A bin is named by (shard, bin).
    """
    longest = max(lengths)
    cut = stored(pieces(docs, words() if n_tokens is None else n_tokens, longest), "pieces")
    name = ["doc_id", "total", "piece", "occurrence"]
    full = cut.where(F.col("n_tokens") == longest).select(
        "doc_id",
        "piece",
        "occurrence",
        "first_token",
        "n_tokens",
        # Two independent hashes name a bin of its own; shards below zero hold only such bins.
        (F.lit(-1) - F.shiftrightunsigned(F.xxhash64(F.lit(1), *name), 1)).alias("shard"),
        F.xxhash64(*name).alias("bin"),
        F.lit(longest).alias("bin_length"),
        F.lit(0).alias("bin_offset"),
    )
    n_shards = max(1, -(-cut.count() // shard))

    def in_shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["n_tokens", "doc_id", "piece", "occurrence"], ascending=[False, True, True, True]
        )
        packed = pack(frame["n_tokens"].to_numpy(), lengths)
        return frame.assign(bin=packed.bins, bin_length=packed.lengths[packed.bins], bin_offset=packed.offsets)

    rest = (
        cut.where(F.col("n_tokens") < longest)
        .withColumn("shard", F.pmod(F.xxhash64(*name), F.lit(n_shards)))
        .drop("total")
        .groupBy("shard")
        .applyInPandas(in_shard, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PACKED}")
    )
    return full.unionByName(rest)


def bins(packed: DataFrame) -> DataFrame:
    """(shard, bin, bin_length, n_pieces, n_tokens) of every bin."""
    return packed.groupBy("shard", "bin", "bin_length").agg(
        F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens")
    )

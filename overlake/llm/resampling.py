"""Importance resampling towards a target distribution of hashed n-grams.

A feature is a run of 1 to ``longest`` consecutive words, joined by one space; it falls into a
bucket by crc32.  A bucket's gain is the floored thousandfold logarithm of how much likelier it
is in the target than in the documents, a document's weight the floored mean of its features'
gains, its score the weight plus Gumbel noise drawn from its key.  The highest scores are a
sample without replacement in proportion to the importance weights.

Method.  The texts of a batch are joined with a sentinel between them; one regular-expression
pass over the joined bytes finds all words and sentinels, whose places are the documents'
offsets among the words.  N-grams that lie across an offset are masked out with
``searchsorted``, and the rest are counted with ``bincount``.

Sizes.  Counts are ``buckets`` numbers a task.  Scores are whole numbers within a range that the
number of documents hardly widens, so ranks come from the sizes of score bands and of scores;
only documents of one score are ever sorted together, and equal rows are one row with a count.

A null text is an empty one; a document without features has weight 0.  A null key draws its
noise as an empty text and comes last among equal scores.  Equal rows take consecutive ranks.
Very long texts are taken in pieces cut between words, with the words before a cut as context.  Empty tables give
empty results; against an empty target or corpus only the smoothing counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from overlake.llm.tables import stored
from overlake.llm.words import encode

BUCKETS, LONGEST = 10_000, 1
#: Documents of fewer words are not drawn; so many of a hundred of the others are.
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
#: Bytes of text joined at once.
JOINED = 2 << 20
#: Scores counted together before scores are counted one by one; ranks that one row is expanded to at once.
BAND, BLOCK = 512, 4_096
#: Features whose bucket a Python worker remembers.
REMEMBERED = 500_000

SENTINEL = b"\x00"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")
_OUTSIDE = re.compile(rb"[^0-9a-z\x80-\xff]")


class _Buckets(dict):
    """Buckets by feature; the sentinel's is -1."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets
        self[SENTINEL] = -1

    def __missing__(self, feature: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self[SENTINEL] = -1
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def _pieces(text: bytes, size: int, context: int) -> Iterator[tuple[bytes, int]]:
    """A text cut between words after every ``size`` bytes, each piece after so many of the words before it."""
    at, before = 0, []
    while len(text) - at > size and (cut := _OUTSIDE.search(text, at + size)):
        yield b" ".join([*before, text[at : cut.start()]]), len(before)
        if context:
            before = [*before, *_WORD.findall(text[at : cut.start()])][-context:]
        at = cut.start()
    yield b" ".join([*before, text[at:]]), len(before)


def _batches(texts: Sequence[str | None], size: int, context: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """(text, piece, words of context) in lists of about ``size`` bytes."""
    held, total = [], 0
    for at, text in enumerate(texts):
        # The sentinel is no word character, nor is what takes its place.
        for piece, before in _pieces(encode(text).lower().replace(SENTINEL, b" "), size, context):
            held.append((at, piece, before))
            total += len(piece)
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def features(texts: Sequence[str | None], buckets: _Buckets, longest: int, joined: int = JOINED) -> Iterator[tuple]:
    """Of each batch: the bucket and the text of every feature, and of every word its text."""
    for batch in _batches(texts, joined, longest - 1):
        # The sentinel after each piece stands at its offset among the words.
        words = _WORD.findall(b"".join([piece + SENTINEL for _, piece, _ in batch]))
        codes = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
        ends = np.flatnonzero(codes < 0)
        piece = np.searchsorted(ends, np.arange(len(words)))
        text = np.array([at for at, _, _ in batch])
        first = np.concatenate([[0], ends[:-1] + 1]) + np.array([before for _, _, before in batch])
        own = (codes >= 0) & (np.arange(len(words)) >= first[piece])
        out, of = [codes[own]], [text[piece[own]]]
        for n in range(2, longest + 1):
            # A run is counted with its last word, and where no offset lies between its ends.
            last = np.flatnonzero(own)
            last = last[last >= n - 1]
            last = last[np.searchsorted(ends, last - n + 1) == piece[last]]
            runs = (b" ".join(words[i - n + 1 : i + 1]) for i in last.tolist())
            out.append(np.fromiter(map(buckets.__getitem__, runs), np.int64, len(last)))
            of.append(text[piece[last]])
        yield np.concatenate(out), np.concatenate(of), of[0]


def counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task sends one row per bucket at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for codes, _, _ in features(batch["text"].tolist(), of, longest):
                total += np.bincount(codes, minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    own = texts.select(F.col(text).alias("text")).mapInPandas(count, "bucket long, n long")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: ``buckets`` numbers, whatever the size of both tables."""
    both = counts(docs, text, longest, buckets).select("bucket", "n", F.lit(0).alias("t"))
    both = both.union(counts(target, text, longest, buckets).select("bucket", F.lit(0), "n"))
    s, t = np.zeros(buckets, np.float64), np.zeros(buckets, np.float64)
    for row in both.groupBy("bucket").agg(F.sum("n").alias("s"), F.sum("t").alias("t")).collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", longest: int = LONGEST) -> Column:
    """(n_words, n_features, weight) of each text, as a struct column."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = held.value
        of = _Buckets(len(own))
        for batch in batches:
            words, size, total = (np.zeros(len(batch), np.int64) for _ in range(3))
            for codes, text_of, word_of in features(batch.tolist(), of, longest):
                words += np.bincount(word_of, minlength=len(batch))
                size += np.bincount(text_of, minlength=len(batch))
                # Sums of whole numbers far below 2^53 are exact in doubles.
                total += np.bincount(text_of, own[codes], len(batch)).astype(np.int64)
            yield pd.DataFrame({"n_words": words, "n_features": size, "weight": total // np.maximum(size, 1)})

    return found(F.col(text))


def noise(key: Column, seed: int = SEED) -> Column:
    """The floored thousandfold Gumbel draw that belongs to a key."""
    written = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(written, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def _expanded(rows: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says, with ``nth`` from 0; a row of many copies is dealt out in blocks."""
    few = rows.where(f"copies <= {BLOCK}").withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    many = rows.where(f"copies > {BLOCK}")
    many = many.withColumn("_block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {BLOCK})")))
    many = many.repartition("key", "_block")
    inside = F.expr(f"sequence(_block * {BLOCK}, least(_block * {BLOCK} + {BLOCK - 1}, copies - 1))")
    return few.unionByName(many.withColumn("nth", F.explode(inside)).drop("_block"))


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds ``rank`` to (key, n_words, n_features, weight, score): from 1 for those drawn, else null.

    Bands of scores are summed in one task, scores in one task per band, and documents are
    ordered within their score; scores span some ten thousand values at most.
    """
    columns = ["key", "n_words", "n_features", "weight", "score"]
    rows = stored(scored.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")), "resampling-scores")
    may = F.col("n_words") >= least_words
    sizes = rows.where(may).groupBy("score").agg(F.sum("copies").alias("n")).withColumn("band", F.floor(F.col("score") / BAND))
    bands = sizes.groupBy("band").agg(F.sum("n").alias("n"))
    higher = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    all_bands = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = bands.select(
        "band",
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
        F.floor(F.sum("n").over(all_bands) * percent / 100).alias("quota"),
    )
    higher = Window.partitionBy("band").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    # One row per band and per score: bounded by the range of scores, not by the documents.
    before = (
        sizes.join(F.broadcast(bands), "band")
        .select("score", (F.col("above") + F.coalesce(F.sum("n").over(higher), F.lit(0))).alias("before"), "quota")
        .where("before < quota")
    )
    before = F.broadcast(stored(before, "resampling-ranks"))
    smaller = (
        Window.partitionBy("score")
        .orderBy(F.col("key").asc_nulls_last(), "n_words", "n_features", "weight")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    drawn = rows.where(may).join(before, "score").withColumn("before", F.col("before") + F.coalesce(F.sum("copies").over(smaller), F.lit(0)))
    drawn = _expanded(drawn).withColumn("rank", F.col("before") + F.col("nth") + 1)
    drawn = drawn.select(*columns, F.when(F.col("rank") <= F.col("quota"), F.col("rank")).alias("rank"))
    rest = rows.where(may).join(before, "score", "left_anti").union(rows.where(~may).select("score", *[c for c in rows.columns if c != "score"]))
    return drawn.unionByName(_expanded(rest).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every document."""
    weighed = docs.select(F.col(key).alias("key"), weigh(docs, gains(docs, target, text), text).alias("w"))
    scored = weighed.select("key", "w.*").withColumn("score", F.col("weight") + noise(F.col("key")))
    return draw(scored)

"""Benchmark decontamination by suffix arrays over shards of the training texts.

Benchmark words get small numbers; every other word is 0, as it ends any match.  Each shard
of training texts is a sequence of such numbers.  Its suffix array holds the suffixes that
can reach the shortest window: those that begin with at least so many benchmark words.  Every
window of a test item is looked up by binary search; a found range lists all its occurrences,
from which the longest verbatim match and its location are extended word by word.

An item of ``WINDOW`` words or more is matched by its windows of that many consecutive words,
a shorter one by all its words; an item without words matches nothing.  A text is contaminated
when at least a twentieth of its words lie inside matches.

Null texts have no words.  Null item ids take part as the text ``null`` only in the item list;
repeated items count once per id.  Rows of training texts may repeat: each gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.words import WORD_BYTES, encode

WINDOW = 13
#: A text is contaminated if one word in so many is hit.
SHARE = 20
#: Words of the benchmark that are searched for in one pass over the texts.
BLOCK_WORDS = 2_000_000
#: Training words whose suffixes are sorted together.
SHARD_WORDS = 1_000_000


def words(text: str | None) -> list[bytes]:
    return encode(text).translate(WORD_BYTES).split()


class Benchmark:
    """Test items of one block: word numbers, and their distinct windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.names: list[str] = []
        self.sequences: list[np.ndarray] = []
        self.windows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for name, item in items:
            if not item:
                continue
            own = [self.number.setdefault(w, len(self.number) + 1) for w in item]
            at = len(self.names)
            self.names.append(name)
            self.sequences.append(np.array(own, np.int64))
            size = min(window, len(own))
            for start in range(len(own) - size + 1):
                self.windows.setdefault(tuple(own[start : start + size]), []).append((at, start))
        self.keys = list(self.windows)
        self.shortest = min(map(len, self.keys), default=1)


    def numbered(self, text: str | None) -> np.ndarray:
        """Word numbers of a text, and a zero."""
        own = words(text)
        return np.fromiter((*map(self.number.get, own, repeat(0)), 0), np.int32, len(own) + 1)


class SuffixArray:
    """Sorted suffixes of a sequence of numbers, compared over ``depth`` words at most.

    Zeros end a suffix.  Suffixes with fewer than ``least`` words are left out.
    """

    def __init__(self, sequence: np.ndarray, least: int, depth: int):
        n = len(sequence)
        self.sequence = np.concatenate([sequence, np.zeros(depth, sequence.dtype)])
        zeros = np.flatnonzero(np.concatenate([sequence, [0]]) == 0)
        run = zeros[np.searchsorted(zeros, np.arange(n))] - np.arange(n)
        suffixes = np.flatnonzero(run >= least)
        self.depth, self.length = depth, np.minimum(run[suffixes], depth)
        columns = [np.where(j < self.length, self.sequence[suffixes + j], 0) for j in range(depth)]
        order = np.lexsort(columns[::-1]) if len(suffixes) else np.zeros(0, np.int64)
        self.suffixes = suffixes[order]
        self.columns = [c[order] for c in columns]

    def ranges(self, keys: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the suffixes that begin with each key: one binary search per word."""
        low = np.zeros(len(keys), np.int64)
        high = np.full(len(keys), len(self.suffixes))
        sizes = np.array([len(k) for k in keys], np.int64)
        for j in range(int(sizes.max(initial=0))):
            longer = np.flatnonzero((sizes > j) & (low < high))
            if not len(longer):
                break
            wanted = np.array([keys[i][j] for i in longer])
            low[longer], high[longer] = (
                self._search(self.columns[j], low[longer], high[longer], wanted, False),
                self._search(self.columns[j], low[longer], high[longer], wanted, True),
            )
        return low, high

    @staticmethod
    def _search(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while (going := low < high).any():
            middle = (low + high) // 2
            value = column[np.minimum(middle, len(column) - 1)]
            right = going & ((value <= wanted) if after else (value < wanted))
            low = np.where(right, middle + 1, low)
            high = np.where(going & ~right, middle, high)
        return low


def _extended(sequence: np.ndarray, at: int, item: np.ndarray, start: int, known: int) -> int:
    """Length of the match of ``item[start:]`` at ``sequence[at:]``, known to reach ``known``."""
    most = min(len(sequence) - at, len(item) - start)
    a, b = sequence[at + known : at + most], item[start + known : start + most]
    differ = np.flatnonzero(a != b)
    return known + (int(differ[0]) if len(differ) else len(b))


def search_shard(benchmark: Benchmark, texts: list[np.ndarray]) -> list[tuple]:
    """Of each text: words, hit mask, item numbers, and (length, item number, first word) of the longest match.

    Texts are given as word numbers, with a zero after each, which keeps matches inside it.
    """
    counts = np.array([len(t) - 1 for t in texts])
    begin = np.cumsum(counts + 1) - (counts + 1)
    sequence = np.concatenate(texts)
    depth = max(map(len, benchmark.keys), default=1)
    array = SuffixArray(sequence, benchmark.shortest, depth)
    low, high = array.ranges(benchmark.keys)
    sizes = np.array([len(k) for k in benchmark.keys], np.int64)
    found = np.flatnonzero(high > low)
    repeats = high[found] - low[found]
    place = array.suffixes[np.arange(int(repeats.sum())) + np.repeat(low[found] - (np.cumsum(repeats) - repeats), repeats)]
    key = np.repeat(found, repeats)
    edge = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + sizes[key], -1)
    hit = np.cumsum(edge)[:-1] > 0
    owner = np.searchsorted(begin, place, "right") - 1
    items: list[set[int]] = [set() for _ in texts]
    longest = [(0, -1, -1) for _ in texts]
    order = np.lexsort((place, key, owner))
    for o, k, p in zip(owner[order].tolist(), key[order].tolist(), place[order].tolist(), strict=True):
        size = int(sizes[k])
        for item, start in benchmark.windows[benchmark.keys[k]]:
            items[o].add(item)
            # A match that goes on to the left was found from its own beginning.
            if start and p > begin[o] and sequence[p - 1] == benchmark.sequences[item][start - 1]:
                continue
            length = _extended(sequence, p, benchmark.sequences[item], start, size)
            longest[o] = max(longest[o], (length, -item, -(p - int(begin[o]))))
    return [
        (int(n), hit[b : b + n], found_items, (size, -item, -start) if size else (0, -1, -1))
        for n, b, found_items, (size, item, start) in zip(counts, begin, items, longest, strict=True)
    ]


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Benchmark]:
    """The test items in blocks of bounded size; the driver holds one row batch and the blocks."""
    held, size = {}, 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), "text").orderBy("id", "text")
    for row in rows.toLocalIterator():
        own = words(row["text"])
        held.setdefault((row["id"], tuple(own)), own)
        size += len(own)
        if size >= block_words:
            yield Benchmark([(name, item) for (name, _), item in held.items()])
            held, size = {}, 0
    yield Benchmark([(name, item) for (name, _), item in held.items()])


def _pass(docs: DataFrame, benchmark: Benchmark, text: str) -> Column:
    """One Python pass over the texts, for one block of the benchmark."""
    held = docs.sparkSession.sparkContext.broadcast(benchmark)

    @F.pandas_udf("n_words long, starts array<long>, ends array<long>, items array<string>, longest long, longest_item string, longest_start long")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = held.value
        for batch in batches:
            out, shard, size = [], [], 0
            for i, t in enumerate(batch):
                shard.append(own.numbered(t))
                size += len(shard[-1])
                if size >= SHARD_WORDS or i == len(batch) - 1:
                    out += search_shard(own, shard)
                    shard, size = [], 0
            edges = [np.flatnonzero(np.diff(hit, prepend=False, append=False)) for _, hit, _, _ in out]
            yield pd.DataFrame(
                {
                    "n_words": [n for n, _, _, _ in out],
                    "starts": [e[0::2] for e in edges],
                    "ends": [e[1::2] for e in edges],
                    "items": [sorted({own.names[x] for x in items}) for _, _, items, _ in out],
                    "longest": [m[0] for *_, m in out],
                    "longest_item": [own.names[m[1]] if m[0] else None for *_, m in out],
                    "longest_start": [m[2] if m[0] else None for *_, m in out],
                }
            )

    return search(F.col(text))


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Column:
    """What the benchmark has in common with each text, as a struct column.

    ``n_words``; ``hits``, the spans (start, end) of words inside matches, those of one block
    of the benchmark disjoint; ``items`` with occurring windows, sorted as text; ``longest`` verbatim match, its
    item and first word.  Each block of the benchmark is one broadcast and one Python pass.
    """
    parts = [_pass(docs, block, text) for block in blocks(benchmark)]
    best = F.array_max(
        F.array(*[F.struct(p["longest"].alias("longest"), p["longest_item"].alias("item"), p["longest_start"].alias("start")) for p in parts])
    )
    return F.struct(
        parts[0]["n_words"].alias("n_words"),
        F.flatten(F.array(*[F.arrays_zip(p["starts"].alias("start"), p["ends"].alias("end")) for p in parts])).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts])))).alias("items"),
        best["longest"].alias("longest"),
        best["item"].alias("longest_item"),
        best["start"].alias("longest_start"),
    )


def covered(hits: Column) -> Column:
    """Words inside the union of all spans."""

    def add(state: Column, span: Column) -> Column:
        more = F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], state["reached"]))
        return F.struct((state["total"] + more).alias("total"), F.greatest(state["reached"], span["end"]).alias("reached"))

    nothing = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reached"))
    return F.aggregate(F.array_sort(hits), nothing, add, lambda state: state["total"])


def contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (n_hit * SHARE >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    found = "_contamination"
    while found in docs.columns:
        found += "_"
    marked = docs.withColumn(found, matches(docs, benchmark))
    return marked.where(~contaminated(F.col(f"{found}.n_words"), covered(F.col(f"{found}.hits")))).drop(found)

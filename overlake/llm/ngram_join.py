"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of five words.  Documents of equal sets are one class, so
copies cost nothing further.  Each class is embedded as ``COORDINATES`` min-hash tokens, on
which the join recurses: a node samples coordinates by its path, and a set goes to the child of
each token it has there, so similar sets stay together.  Buckets of at most ``BUCKET`` sets are
compared by brute force on packed tokens.  Larger ones split further; what ``DEEP`` levels don't
split is dense and joined whole.  ``RUNS`` independent runs reach the target recall: a pair at the
threshold is missed with a chance of about 1 in 100,000, a closer one with less.

What meets is only a candidate.  Candidates form loose clusters, and inside each every pair is
checked once on the exact sets: small clusters many to a task, larger ones as a grid of blocks.
The check sends no pairs on but, for every class, its number of links and one tie.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters.  A text of fewer
than five words, but not none, has one shingle of all of them.  Null texts and texts without
words have no links and each is a class of its own.  Rows may repeat: each gives a row, and
rows that agree are copies.  Classes are named by their smallest key, nulls last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlake.llm.components import components
from overlake.llm.tables import stored
from overlake.llm.words import Words, chunks, mix, seeds, shingles

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 64
RUNS = 10
#: Levels of the recursion before buckets are counted, and for buckets that are still large.
#: These split several times anew, as two more levels part more similar pairs.
LEVELS, DEEP, REPEATS = 2, 4, 3
BUCKET = 1_024
#: Equal tokens, of ``COORDINATES``, from which a pair is a candidate: below the threshold by 3.7 deviations.
AGREE = 39
#: Classes of a cluster that one task checks against each other; larger clusters go by blocks of half as many.
TASK = 1_024
BLOCK = 512

SETS = "n int, f1 long, f2 long, tokens binary"


def signatures(texts: list[str | None], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: distinct shingles, two hashes of the set, and its min-hash tokens (32 bits each)."""
    sizes, prints, tokens = [], [], []
    factor, shift = seeds(COORDINATES, 3).astype(np.uint32) | np.uint32(1), seeds(COORDINATES, 4).astype(np.uint32)
    for _, encoded in chunks(texts):
        words = Words(encoded)
        own, offsets = shingles(words.hashes(), words.offsets, n)
        own, offsets = distinct(own, offsets)
        counts = np.diff(offsets)
        out = np.zeros((len(encoded), COORDINATES), np.uint32)
        sums = np.zeros((len(encoded), 2), np.uint64)
        some = np.flatnonzero(counts)
        if len(some):
            first = offsets[:-1][some]
            sums[some, 0] = mix(np.add.reduceat(own, first))
            sums[some, 1] = mix(np.add.reduceat(mix(own + np.uint64(77)), first))
            short = (own >> np.uint64(32)).astype(np.uint32)
            for c in range(COORDINATES):
                out[some, c] = np.minimum.reduceat((short ^ shift[c]) * factor[c], first)
        sizes.append(counts)
        prints.append(sums)
        tokens.append(out)
    return np.concatenate(sizes), np.concatenate(prints), np.concatenate(tokens)


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[new], minlength=len(offsets) - 1)
    return values[new], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _content(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("c1"), F.xxhash64(F.lit(7), text).alias("c2")]


def sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, c1, c2, n, f1, f2, tokens) of each row, stored: text hashes, set size and hashes, tokens."""

    @F.pandas_udf(SETS)
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, prints, tokens = signatures(list(batch))
            yield pd.DataFrame(
                {
                    "n": n.astype(np.int32),
                    "f1": prints[:, 0].view(np.int64),
                    "f2": prints[:, 1].view(np.int64),
                    "tokens": [t.tobytes() if k else b"" for t, k in zip(tokens.astype("<u4"), n, strict=True)],
                }
            )

    rows = docs.select(F.col(key).alias("key"), *_content(F.col(text)), sign(F.col(text)).alias("s"))
    return stored(rows.select("key", "c1", "c2", "s.*"), "shingle-sets")


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct set: number in key order, smallest key, one text's hashes, copies, tokens; stored."""
    owner = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), "c1", "c2")
    return stored(
        rows.where("n > 0")
        .groupBy("f1", "f2", "n")
        .agg(F.min(owner).alias("owner"), F.count(F.lit(1)).alias("copies"), F.first("tokens").alias("tokens"))
        .orderBy("owner", "f1", "f2", "n")
        .select(F.monotonically_increasing_id().alias("cls"), "f1", "f2", "n", "owner", "copies", "tokens"),
        "shingle-classes",
    )


def _split(paths: np.ndarray, rows: np.ndarray, tokens: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths of sets after more levels of the recursion, and the row of each.

    A node takes one coordinate, and with a chance of a quarter a second one: 1 / THRESHOLD
    on average.  The choice depends on the path alone, so it is the same for all its sets.
    """
    for level in range(levels):
        draw = mix(paths + np.uint64(level + 1))
        one = (draw & np.uint64(COORDINATES - 1)).astype(np.int64)
        other = (draw >> np.uint64(8) & np.uint64(COORDINATES - 1)).astype(np.int64)
        again = np.flatnonzero(((draw >> np.uint64(16)) & np.uint64(3) == 0) & (one != other))
        at = np.concatenate([np.arange(len(rows)), again])
        coordinate = np.concatenate([one, other[again]])
        token = tokens[rows[at], coordinate].astype(np.uint64) + (coordinate.astype(np.uint64) << np.uint64(32))
        paths, rows = mix(paths[at] ^ mix(token + np.uint64(1))), rows[at]
    return paths, rows


def _packed(tokens: np.ndarray) -> np.ndarray:
    """Four bits of each token."""
    low = (mix(tokens.astype(np.uint64)) & np.uint64(15)).astype(np.uint8)
    return low[:, 0::2] | low[:, 1::2] << 4


def _tokens(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, COORDINATES)


def _paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From (cls, tokens), and (path) where the recursion goes on: (path, cls, packed)."""
    for frame in frames:
        if not len(frame):
            continue
        tokens, own = _tokens(frame["tokens"]), np.arange(len(frame))
        if "path" in frame:
            path = frame["path"].to_numpy(np.int64).view(np.uint64)
            again = np.concatenate([mix(path + np.uint64(1000 + k)) for k in range(REPEATS)])
            paths, rows = _split(again, np.tile(own, REPEATS), tokens, DEEP - LEVELS)
        else:
            start = mix(np.arange(1, RUNS + 1, dtype=np.uint64))
            paths, rows = _split(np.repeat(start, len(own)), np.tile(own, RUNS), tokens, LEVELS)
        packed = [p.tobytes() for p in _packed(tokens)]
        yield pd.DataFrame({"path": paths.view(np.int64), "cls": frame["cls"].to_numpy()[rows], "packed": [packed[r] for r in rows]})


def linked(size: int, similar: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member tied to each of ``size`` members by the given pairs, directly or not."""
    root = np.arange(size)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for left, right in similar:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(size)], np.int64)


def _close(packed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with enough equal tokens, some rows at a time."""
    low, high = packed & 15, packed >> 4
    for at in range(0, len(packed), 64):
        part = slice(at, at + 64)
        agree = (low[part, None] == low[None]).sum(2, dtype=np.int16) + (high[part, None] == high[None]).sum(2, dtype=np.int16)
        left, right = np.nonzero(agree >= AGREE)
        keep = left + at < right
        yield left[keep] + at, right[keep]


def _bucket_edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ties (a, b) between similar sets of the buckets in rows (path, cls, packed) sorted by path."""
    held: list[pd.DataFrame] = []

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        path, cls = frame["path"].to_numpy(), frame["cls"].to_numpy()
        start = np.flatnonzero(np.diff(path, prepend=path[0] - 1))
        size = np.diff(np.append(start, len(path)))
        several = size > 1
        taken = np.repeat(several, size)
        packed = np.zeros((len(path), COORDINATES // 2), np.uint8)
        if taken.any():
            packed[taken] = np.frombuffer(b"".join(frame["packed"].to_numpy()[taken]), np.uint8).reshape(-1, COORDINATES // 2)
        a, b = [], []
        for s, n in zip(start[several].tolist(), size[several].tolist(), strict=True):
            root = linked(n, _close(packed[s : s + n]))
            tied = np.flatnonzero(root != np.arange(n))
            own = cls[s : s + n]
            differ = own[tied] != own[root[tied]]
            a.append(own[tied][differ])
            b.append(own[root[tied]][differ])
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"a": np.concatenate(a + none), "b": np.concatenate(b + none)}).drop_duplicates()

    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        path = frame["path"].to_numpy()
        last = np.flatnonzero(path != path[-1])
        if len(last):  # the last bucket may go on in the next batch
            whole = pd.concat(held, ignore_index=True)
            keep = len(whole) - (len(path) - last[-1] - 1)
            yield solve(whole.iloc[:keep])
            held = [whole.iloc[keep:]]
    if held:
        yield solve(pd.concat(held, ignore_index=True))


def candidates(own: DataFrame) -> DataFrame:
    """Ties (a, b) between classes that may be similar: never more than bucket members."""
    paths = "path long, cls long, packed binary"
    rows = own.select("cls", "tokens").mapInPandas(_paths, paths)
    hot = stored(rows.groupBy("path").count().where(F.col("count") > BUCKET).select("path"), "hot-buckets")
    whole = None
    if not hot.isEmpty():
        more = (
            rows.join(hot, "path", "left_semi").select("path", "cls").join(own.select("cls", "tokens"), "cls").mapInPandas(_paths, paths)
        )
        more = stored(more, "deep-paths")
        dense = more.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("b")).where(F.col("n") > BUCKET)
        whole = more.select("path", "cls").join(dense, "path").where("cls <> b").select(F.col("cls").alias("a"), "b")
        rows = rows.join(hot, "path", "left_anti").unionByName(more.join(dense, "path", "left_anti"))
    ties = rows.repartition("path").sortWithinPartitions("path").mapInPandas(_bucket_edges, "a long, b long")
    return ties if whole is None else ties.unionByName(whole)


def shared(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Numbers of values that each two of ``n`` sets have in common, as a matrix."""
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(values)))
    several = np.repeat(size > 1, size)
    column = np.cumsum(np.repeat(size > 1, size) & new) - 1
    owner, column = owner[several], column[several]
    total = np.zeros((n, n), np.float32)
    step = max(1, (1 << 22) // max(n, 1))  # columns that are held at once
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [at, at + step])
        part = np.zeros((n, step), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total


def _checked(frame: pd.DataFrame) -> pd.DataFrame:
    """Exact links among the classes of each cluster in one task.

    Rows: task, cluster, cls, copies, side, text.  Side 0 meets all of its cluster; sides 1 and 2
    are two blocks, of which only pairs across are compared here.
    """
    frame = frame.sort_values(["cluster", "cls"], kind="stable")
    cluster, cls = frame["cluster"].to_numpy(), frame["cls"].to_numpy()
    copies, side = frame["copies"].to_numpy(), frame["side"].to_numpy()
    values, offsets = [], [np.zeros(1, np.int64)]
    for _, encoded in chunks(list(frame["text"])):
        words = Words(encoded)
        own, where = distinct(*shingles(words.hashes(), words.offsets, SHINGLE))
        values.append(own)
        offsets.append(where[1:] + offsets[-1][-1])
    values, offsets = np.concatenate(values), np.concatenate(offsets)
    sizes = np.diff(offsets)
    edges = np.append(np.flatnonzero(np.diff(cluster, prepend=cluster[0] - 1)), len(cluster))
    links, root = np.zeros(len(cls), np.int64), cls.copy()
    for s, e in zip(edges, edges[1:], strict=False):
        n = e - s
        common = shared(values[offsets[s] : offsets[e]], np.repeat(np.arange(n), sizes[s:e]), n)
        union = sizes[s:e, None] + sizes[None, s:e] - common
        alike = common >= THRESHOLD * union - 1e-6
        alike &= (side[s:e, None] != side[None, s:e]) | (side[s:e, None] == 0)
        np.fill_diagonal(alike, False)
        links[s:e] = alike @ copies[s:e]
        left, right = np.nonzero(np.triu(alike))
        root[s:e] = cls[s:e][linked(n, iter([(left, right)]))]
    return pd.DataFrame({"cls": cls, "root": root, "links": links})


def _tasks(members: DataFrame) -> DataFrame:
    """Members (cluster, cls, ...) with the task, and side in it, of every comparison they take part in."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    members = members.join(sizes, "cluster")
    total = members.where(F.col("size") <= TASK).count()
    n_tasks = max(1, -(-total // TASK))
    small = members.where(F.col("size") <= TASK).select(
        F.pmod(F.xxhash64("cluster"), F.lit(n_tasks)).alias("t1"), F.lit(-1).cast("long").alias("t2"), F.lit(-1).cast("long").alias("t3"),
        F.lit(0).alias("side"), "*",
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks"))
    other = F.col("other")
    large = (
        members.where(F.col("size") > TASK)
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.col("cluster").alias("t1"),
            F.least("own", other).alias("t2"),
            F.greatest("own", other).alias("t3"),
            F.when(F.col("own") == other, 0).when(F.col("own") < other, 1).otherwise(2).alias("side"),
            *members.columns,
        )
    )
    return small.unionByName(large)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, c1, c2, n_shingles, cls, class_id, class_c1, class_c2, n_links) of every row of ``docs``.

    ``class_id`` is the smallest key of the rows tied by links; ``n_links`` counts the rows whose
    set has a Jaccard similarity of ``THRESHOLD`` or more with the row's own, copies included.
    (class_id, class_c1, class_c2) is the row that stands for the class: c1 and c2 are hashes of
    the text.
    """
    rows = sets(docs, key, text)
    own = classes(rows)
    clusters = components(candidates(own))
    members = own.join(clusters, own["cls"] == clusters["node"]).select(
        F.col("root").alias("cluster"), "cls", "copies", F.col("owner.c1").alias("c1"), F.col("owner.c2").alias("c2")
    )
    members = stored(members, "loose-clusters")
    # Copies of a text meet in a partial aggregate; the join needs no other exchange of texts.
    texts = docs.select(*_content(F.col(text)), F.col(text).alias("text")).groupBy("c1", "c2").agg(F.first("text").alias("text"))
    tasks = _tasks(members.join(texts, ["c1", "c2"]).select("cluster", "cls", "copies", "text"))
    checked = stored(
        tasks.groupBy("t1", "t2", "t3").applyInPandas(_checked, "cls long, root long, links long"), "links"
    )
    links = checked.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    name = own.select(F.col("cls").alias("root"), F.col("owner").alias("representative"))
    about = (
        own.select("cls", "f1", "f2", "n", "copies")
        .join(roots, "cls", "left")
        .join(links, "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
        .join(name, "root")
        .select(
            "f1", "f2", "n", "cls", F.struct("representative.key", "representative.c1", "representative.c2").alias("of"),
            (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
        )
    )
    itself = F.struct(F.col("key").alias("key"), "c1", "c2")
    of = F.coalesce("of", itself)
    return rows.join(about, ["f1", "f2", "n"], "left").select(
        "key", "c1", "c2", F.col("n").alias("n_shingles"), "cls",
        of["key"].alias("class_id"), of["c1"].alias("class_c1"), of["c2"].alias("class_c2"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, and all rows without words."""
    found = join(docs, key, text)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, *_content(F.col(text)), F.col(key).alias("key"))
    same = (F.col("key").eqNullSafe(F.col("class_id"))) & (F.col("c1") == F.col("class_c1")) & (F.col("c2") == F.col("class_c2"))
    kept = found.where("n_shingles > 0").where(same).select("c1", "c2", F.col("key").alias("kept"), F.lit(False).alias("bare"))
    bare = found.where("n_shingles = 0").select("c1", "c2", F.lit(None).cast(kept.schema["kept"].dataType), F.lit(True))
    # Texts are exchanged once, by their hashes.  Rows that repeat a document which stands for its
    # class are one group; rows without words stay apart, by a number that only this task sees.
    chosen = rows.join(kept.union(bare).distinct(), ["c1", "c2"]).where(F.col("bare") | F.col("key").eqNullSafe(F.col("kept")))
    apart = F.when(F.col("bare"), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    standing = chosen.withColumn("apart", apart).groupBy("c1", "c2", "apart").agg(F.first("_row").alias("_row"))
    return standing.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

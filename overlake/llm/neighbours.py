"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree hashes a vector to a long string of bits, one per random hyperplane, and is nothing
but the sorted array of these strings.  A query descends every tree to its longest matching
prefix by binary search, then all trees ascend together, one bit at a time, until enough
different candidates share the prefix.  Candidates are ranked by their exact cosine.

The vectors are dealt to shards by hash; a shard is one row of the index with its vectors and
its trees.  Queries are a stated set: they go over all shards in blocks of ``BLOCK``, each
shard returns its nearest few, and Spark merges these.  How many candidates are enough is
fitted on a sample of ``SAMPLE`` vectors, as the share that reaches ``TARGET`` recall there.

Vectors that are null, empty, zero, or hold null or non-finite components take no part.
Rows that agree in id and vector count once; rows with a query's id are no candidates of it.
Vectors of different lengths are never compared.  Components may be as large or as small as a
double can be: squares of such would not fit, so these vectors are scaled first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from overlake.llm.tables import stored

TREES = 32
BITS = 24
SHARD = 4_096
#: Queries that visit the shards together; a block is what the driver holds and broadcasts.
BLOCK = 4_096
#: Vectors of the sample on which the candidate share is fitted, queries taken from it, and recall sought.
SAMPLE, SAMPLE_QUERIES, TARGET = 4_096, 200, 0.95
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 1.0)


def planes(dim: int) -> np.ndarray:
    """The hyperplanes of all trees for vectors of a length: the same everywhere."""
    return np.random.default_rng(dim).normal(size=(TREES, BITS, dim))


def strings(vectors: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hash strings of each tree, as numbers whose high bits come first: trees x vectors."""
    powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return np.stack([((vectors @ tree.T) > 0) @ powers for tree in of])


@dataclass
class Forest:
    ids: np.ndarray
    vectors: np.ndarray
    sorted: np.ndarray  # trees x n, hash strings in order
    order: np.ndarray  # trees x n, the vector of each

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Forest:
        hashed = strings(vectors, planes(vectors.shape[1]))
        order = np.argsort(hashed, axis=1, kind="stable")
        return cls(ids, vectors, np.take_along_axis(hashed, order, 1), order)

    def bounds(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the vectors that share each prefix: arrays of prefix length x trees x queries."""
        low = np.empty((BITS + 1, *hashed.shape), np.int64)
        high = np.empty_like(low)
        for length in range(BITS + 1):
            rest = (1 << (BITS - length)) - 1
            for t in range(len(hashed)):
                low[length, t] = np.searchsorted(self.sorted[t], hashed[t] & ~rest, "left")
                high[length, t] = np.searchsorted(self.sorted[t], hashed[t] | rest, "right")
        return low, high

    def candidates(self, hashed: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query a mask of its candidates: at least ``enough``, or all there are."""
        low, high = self.bounds(hashed)
        totals = (high - low).sum(1)
        for q in range(hashed.shape[1]):
            length = BITS
            while True:
                while length and totals[length, q] < enough:
                    length -= 1
                mask = np.zeros(len(self.ids), bool)
                for t in range(len(hashed)):
                    mask[self.order[t, low[length, t, q] : high[length, t, q]]] = True
                if not length or np.count_nonzero(mask) >= enough:
                    yield mask
                    break
                length -= 1

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, cosines) of the best ``k`` candidates: largest cosine, then smallest id."""
        enough = max(k + 1, int(np.ceil(share * len(self.ids))))
        norms = np.sqrt((self.vectors**2).sum(1))
        hashed = strings(queries, planes(queries.shape[1]))
        for q, mask in enumerate(self.candidates(hashed, enough)):
            at = np.flatnonzero(mask & (self.ids != ids[q]))
            score = (self.vectors[at] @ queries[q]) / (norms[at] * np.sqrt((queries[q] ** 2).sum()))
            best = np.lexsort((self.ids[at], -score))[:k]
            yield q, self.ids[at[best]], score[best]


def valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, dim) of rows that can take part, each different row once."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0))
        .dropDuplicates(["id", "vector"])
        .withColumn("dim", F.size("vector"))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    """Vectors as rows; very large and very small ones are moved by a power of two, which changes no cosine."""
    rows = np.array(column.tolist(), dtype=np.float64)
    largest = np.abs(rows).max(axis=1)
    far = (largest < 1e-100) | (largest > 1e100)
    if far.any():
        rows[far] = np.ldexp(rows[far], -np.frexp(largest[far])[1][:, None])
    return rows


def build(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """The index: (dim, shard, n, ids, vectors, sorted, order), one row per shard, stored."""
    n_shards = max(1, -(-vectors.count() // shard))

    def forest(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        own = Forest.build(frame["id"].to_numpy(np.int64), _matrix(frame["vector"]))
        return pd.DataFrame(
            {
                "dim": [int(frame["dim"].iloc[0])],
                "shard": [int(frame["shard"].iloc[0])],
                "n": [len(frame)],
                "ids": [own.ids.astype("<i8").tobytes()],
                "vectors": [own.vectors.astype("<f8").tobytes()],
                "sorted": [own.sorted.astype("<u4").tobytes()],
                "order": [own.order.astype("<u4").tobytes()],
            }
        )

    index = (
        vectors.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(n_shards)))
        .groupBy("dim", "shard")
        .applyInPandas(forest, "dim int, shard long, n int, ids binary, vectors binary, sorted binary, order binary")
    )
    return stored(index, "forest")


def fit_share(vectors: DataFrame, k: int) -> float:
    """The least share of a shard that must be candidates for ``TARGET`` recall on the sample."""
    rows = vectors.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(SAMPLE).select("id", "vector", "dim").toPandas()
    needed = SHARES[0]
    for _, own in rows.groupby("dim"):
        forest = Forest.build(own["id"].to_numpy(np.int64), _matrix(own["vector"]))
        ids, queries = forest.ids[:SAMPLE_QUERIES], forest.vectors[:SAMPLE_QUERIES]
        true = [set(near.tolist()) for _, near, _ in forest.nearest(ids, queries, k, 1.0)]
        total = sum(map(len, true))
        for share in SHARES:
            got = sum(len(true[q] & set(near.tolist())) for q, near, _ in forest.nearest(ids, queries, k, share))
            if got >= TARGET * total:
                break
        needed = max(needed, share)
    return needed


def search(index: DataFrame, queries: DataFrame, k: int, share: float) -> DataFrame:
    """(query_id, query_no, rank, vec_id, score): the nearest ``k`` of each row of ``queries`` (id, vector, dim)."""
    spark = index.sparkSession
    n_blocks = max(1, -(-queries.count() // BLOCK))
    parts = []
    for block in range(n_blocks):
        # About BLOCK rows, dealt by hash: bounded whatever the number of queries.
        own = (
            queries.where(F.pmod(F.xxhash64(F.lit(4), "id", "vector"), F.lit(n_blocks)) == block)
            .select("id", "vector", "dim")
            .toPandas()
            .sort_values("id", kind="stable")
        )
        held = spark.sparkContext.broadcast({d: (g["id"].to_numpy(np.int64), _matrix(g["vector"])) for d, g in own.groupby("dim")})
        parts.append(index.mapInPandas(_searcher(held, block, k, share), "query_id long, query_no long, vec_id long, score double"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "query_no", "rank", "vec_id", "score")
    )


def _searcher(held, block: int, k: int, share: float):
    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                if row.dim not in held.value:
                    continue
                ids, queries = held.value[row.dim]
                read = lambda data, kind, *shape: np.frombuffer(data, kind).reshape(shape)
                forest = Forest(
                    read(row.ids, "<i8", row.n),
                    read(row.vectors, "<f8", row.n, row.dim),
                    read(row.sorted, "<u4", TREES, row.n).astype(np.int64),
                    read(row.order, "<u4", TREES, row.n).astype(np.int64),
                )
                found = list(forest.nearest(ids, queries, k, share))
                sizes = [len(near) for _, near, _ in found]
                at = np.repeat([q for q, _, _ in found], sizes).astype(np.int64)
                yield pd.DataFrame(
                    {
                        "query_id": ids[at],
                        "query_no": at + (block << 32) + (row.dim << 48),
                        "vec_id": np.concatenate([near for _, near, _ in found]),
                        "score": np.concatenate([score for _, _, score in found]),
                    }
                )

    return apply

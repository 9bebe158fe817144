import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from overlake.llm import packing
from tests.llm.conftest import CLASHING


def plain(sizes, lengths):
    """Best fit with the same cost rule, by looking at every bin."""
    permitted, bins = sorted(lengths), []
    cost = dict(zip(permitted, packing.costs(permitted), strict=True))
    for i, size in enumerate(sizes):
        fits = [b for b in bins if b[0] - sum(b[1]) >= size]
        if fits:
            min(fits, key=lambda b: (b[0] - sum(b[1]), bins.index(b)))[1].append(size)
            continue
        rest = sizes[i + 1 :]

        def price(c, size=size, rest=rest):
            spare = c - size
            return cost[c] / (size + min(spare, sum(x for x in rest if x <= spare)))

        bins.append((min((c for c in permitted if c >= size), key=price), [size]))
    return [(min(c for c in permitted if c >= sum(b)), sum(b)) for _, b in bins]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_like_looking_at_every_bin(sizes):
    sizes = sorted(sizes, reverse=True)
    packed = packing.pack(np.array(sizes), (16, 32, 64))
    filled = np.bincount(packed.bins, sizes)
    assert (filled <= packed.lengths).all()
    assert sorted(zip(packed.lengths.tolist(), filled.astype(int).tolist(), strict=True)) == sorted(plain(sizes, (16, 32, 64)))
    for b in range(len(filled)):
        own = sorted((packed.offsets[i], s) for i, s in enumerate(sizes) if packed.bins[i] == b)
        assert all(o + s == n for (o, s), (n, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0


def test_pieces_cover_every_token(frame, spark):
    docs = frame([(i, "w " * n) for i, n in enumerate([0, 1, 50, 64, 65, 128, 1000] * 20)])
    out = packing.assign(docs, lengths=(16, 32, 64), shard=50).cache()
    per = out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("c")).collect()
    assert {(r["doc_id"], r["n"]) for r in per} == {(i, n) for i, n in enumerate([0, 1, 50, 64, 65, 128, 1000] * 20) if n}
    assert out.select("doc_id", "first_token").distinct().count() == out.count()
    full = packing.bins(out)
    assert full.where("n_tokens > bin_length").count() == 0
    assert full.select("shard", "bin").distinct().count() == full.count()
    assert full.agg(F.sum("n_tokens") / F.sum("bin_length")).first()[0] > 0.9


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    out = packing.assign(docs)
    tokens = sum(len((t or "").split()) for _, t in odd_rows)
    assert out.agg(F.sum("n_tokens")).first()[0] == tokens
    assert out.where("doc_id = 4").select("occurrence").distinct().count() == 2
    assert packing.assign(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_keys_of_other_types(spark, kind):
    rows = spark.range(40).selectExpr(
        f"CASE WHEN id > 0 THEN {'date_add(DATE 2020-01-01, CAST(id AS int))' if kind == 'date' else f'CAST(id AS {kind})'} END AS doc_id".replace(
            "DATE 2020-01-01", "DATE '2020-01-01'"
        ),
        "repeat('w ', CAST(id % 7 + 1 AS int)) AS text",
    )
    out = packing.assign(rows, lengths=(4, 8), shard=10)
    assert out.schema["doc_id"].dataType == rows.schema["doc_id"].dataType
    assert out.agg(F.sum("n_tokens")).first()[0] == sum(i % 7 + 1 for i in range(40))
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in rows.collect()}


def test_a_token_count_of_ones_own(frame):
    docs = frame([(1, "abc"), (2, "abcdef")])
    out = packing.assign(docs, F.length("text").cast("long"), (4,))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out.collect()) == [(1, 3), (2, 2), (2, 4)]


@pytest.mark.parametrize("size", [1, 4096])
def test_single_piece(size):
    packed = packing.pack(np.array([size]))
    assert packed.lengths.tolist() == [256 if size == 1 else 4096]

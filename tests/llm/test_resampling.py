import numpy as np
import pytest
from pyspark.sql import functions as F

from overlake.llm import queries, resampling
from tests.llm import brute
from tests.llm.conftest import CLASHING, prose, text_of

SMALL = "/root/testdata/sf0.001"


def rows_of(found):
    return sorted([(r["key"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect()], key=repr)


def test_given_tables_like_the_rule(spark):
    rows = queries.op12_resampling(spark, SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(map(tuple, rows), key=repr) == brute.resampled(docs, items)
    assert sum(r["rank"] is not None for r in rows) > 10


@pytest.mark.parametrize("joined", [resampling.JOINED, 40])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_features_of_joined_texts(longest, joined):
    """No n-gram lies across texts, none is lost where a long text is cut, none counts twice."""
    texts = [text_of(prose(1, 90)), None, "", "one", "two words", "A\x00B c", "é" * 200 + " x", text_of(prose(2, 90)), "!?", "z y"]
    of = resampling._Buckets(1 << 30)
    got = [[] for _ in texts]
    words = [0] * len(texts)
    for codes, owner, word_owner in resampling.features(texts, of, longest, joined):
        for code, at in zip(codes.tolist(), owner.tolist(), strict=True):
            got[at].append(code)
        for at in word_owner.tolist():
            words[at] += 1
    for text, own, n in zip(texts, got, words, strict=True):
        w = brute.words(text)
        runs = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        assert sorted(own) == sorted(of[r.encode()] for r in runs) and n == len(w)


def test_longer_features_like_the_rule(spark, frame):
    docs = [(i, text_of(prose(i, 60))) for i in range(30)]
    target = [(0, text_of(prose(3, 80)))]
    table = frame(docs)
    gain = resampling.gains(table, frame(target), longest=2, buckets=500)
    weighed = table.select(F.col("doc_id").alias("key"), resampling.weigh(table, gain, longest=2).alias("w")).select("key", "w.*")
    found = resampling.draw(weighed.withColumn("score", F.col("weight") + resampling.noise(F.col("key"))), percent=50)
    assert rows_of(found) == brute.resampled(docs, target, longest=2, buckets=500, percent=50)


def test_repeated_rows_and_ties(frame, monkeypatch):
    """Equal rows take consecutive ranks, also where they are expanded in blocks."""
    monkeypatch.setattr(resampling, "BLOCK", 4)
    text = text_of(prose(1, 40))
    docs = [(7, text)] * 37 + [(7, text + " more")] * 5 + [(i, text) for i in range(30)] + [(None, text)] * 3
    found = resampling.resample(frame(docs), frame([(0, text)]))
    expected = brute.resampled(docs, [(0, text)])
    assert rows_of(found) == expected and len(expected) == len(docs)


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    target = frame([(1, "one"), (1, "one"), (2, None), (None, text_of(prose(1, 50)))])
    expected = brute.resampled(odd_rows, [(0, "one"), (0, "one"), (0, text_of(prose(1, 50)))])
    assert rows_of(resampling.resample(docs, target)) == expected
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert rows_of(resampling.resample(docs, target.limit(0))) == brute.resampled(odd_rows, [])
    assert resampling.gains(docs.limit(0), target.limit(0)).tolist() == [0] * resampling.BUCKETS


def test_gains_favour_the_target(frame):
    gain = resampling.gains(frame([(1, "a b c d " * 50)]), frame([(1, "a a x x x")]))
    of = resampling._Buckets(resampling.BUCKETS)
    assert gain[of[b"x"]] > gain[of[b"a"]] > gain[of[b"b"]] and gain.dtype == np.int64

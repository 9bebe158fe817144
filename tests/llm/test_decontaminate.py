import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from overlake.llm import decontaminate, queries
from tests.llm import brute
from tests.llm.conftest import CLASHING, prose

SMALL = "/root/testdata/sf0.001"


def digest(docs, benchmark):
    rows = docs.select("doc_id", decontaminate.matches(docs, benchmark).alias("m")).select("doc_id", "m.*")
    rows = rows.withColumn("n_hit", decontaminate.covered(F.col("hits")))
    rows = rows.withColumn("bad", decontaminate.contaminated(F.col("n_words"), F.col("n_hit")))
    return [
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["bad"])
        for r in rows.collect()
    ]


def plain(docs, items):
    return sorted((k, *v) for k, v in brute.contamination(docs, items).items())


@pytest.fixture(scope="module")
def cases():
    p = prose(3, 60)
    items = [
        (1, " ".join(p[:30])), (10, " ".join(p[10:40])), (2, "short Item"), (3, "of"), (4, ""), (5, None), (6, "zz " * 14), (9, " ".join(p[:13])),
    ]
    docs = [
        (1, " ".join(prose(9, 300) + p[:25] + prose(8, 100))),
        (2, "a short-item! short item of"),
        (3, " ".join(p[5:17])),
        (4, " ".join(x.upper() for x in p[5:18])),
        (5, "zz " * 40),
        (6, None),
        (7, ""),
        (8, " ".join(prose(7, 20_000) + p)),
    ]
    return docs, items


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 20])
def test_like_the_rule(spark, frame, cases, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (block_words,))
    docs, items = cases
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(digest(frame(docs), benchmark)) == plain(docs, items)


def test_given_tables_like_the_rule(spark):
    rows = queries.op10_decontaminate(spark, SMALL).drop("longest_match").collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert sorted(map(tuple, rows)) == plain(docs, items)


def test_longest_match_and_its_place(spark, frame, cases):
    docs, items = cases
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    own = frame(docs)
    rows = {r["doc_id"]: r["m"] for r in own.select("doc_id", decontaminate.matches(own, benchmark).alias("m")).collect()}
    assert (rows[1]["longest"], rows[1]["longest_item"], rows[1]["longest_start"]) == (25, "1", 300)


def test_ranges_of_the_suffix_array():
    draw = np.random.default_rng(4)
    sequence = draw.integers(0, 4, 400)
    array = decontaminate.SuffixArray(sequence, 1, 5)
    keys = [tuple(draw.integers(1, 4, n).tolist()) for n in (1, 2, 3, 4, 5) for _ in range(30)]
    low, high = array.ranges(keys)
    for key, a, b in zip(keys, low, high, strict=True):
        expected = {i for i in range(len(sequence)) if tuple(sequence[i : i + len(key)].tolist()) == key}
        assert set(array.suffixes[a:b].tolist()) == expected


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    benchmark = spark.createDataFrame([(None, odd_rows[4][1]), (1, "one"), (1, "one"), (2, None)], "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    left = sorted(str(r["doc_id"]) for r in kept.collect())
    gone = {"3", "4", "5", "10", "11"}
    assert left == sorted(str(k) for k, _ in odd_rows if str(k) not in gone)
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(odd_rows)
    assert decontaminate.clean(docs.limit(0), benchmark).count() == 0

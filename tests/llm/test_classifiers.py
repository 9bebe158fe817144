import numpy as np
import pytest
from pyspark.sql import functions as F

from overlake.llm import language, quality, queries, toxicity
from overlake.llm.tables import held_out
from tests.llm.conftest import CLASHING

SMALL = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.mark.parametrize(
    ("query", "label", "threshold", "least"),
    [(queries.op6_quality, "quality", quality.THRESHOLD, 0.95), (queries.op9_toxicity, "toxic", toxicity.THRESHOLD, 0.93)],
)
def test_held_out_accuracy(spark, query, label, threshold, least):
    found = query(spark, SMALL)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.toPandas()
    assert len(rows) == read(spark, "documents").count() and rows["score"].between(0, 1).all()
    assert ((rows["score"] >= threshold) == (rows["predicted"] == 1)).all()
    both = rows.merge(read(spark, "labels").toPandas(), on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"] == both[label]).mean() >= least


def test_language_accuracy(spark):
    rows = queries.op7_language(spark, SMALL).toPandas()
    both = rows.merge(read(spark, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    both = both[both["held_out"]]
    assert rows["score"].between(0, 1).all() and (both["lang_pred"] == both["lang"]).mean() >= 0.97


def test_held_out_is_the_contracts(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id"), 4, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    wrong = labels.withColumn("quality", F.when(held_out(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels, sample=200), quality.fit(docs, wrong, sample=200)
    assert np.array_equal(a.linear, b.linear) and a.bias == b.bias


def test_pairwise_part_by_sums_of_squares():
    draw = np.random.default_rng(0)
    size = quality.BUCKETS + quality.STATISTICS
    fm = quality.FactorisationMachine(
        0.3, draw.normal(size=size), draw.normal(size=(size, quality.RANK)), np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS)
    )
    buckets, values = np.array([3, 8, 11]), np.array([0.5, 1.0, -2.0], np.float32)
    dense = draw.normal(size=(1, quality.STATISTICS))
    at = np.concatenate([buckets, quality.BUCKETS + np.arange(quality.STATISTICS)])
    x = np.concatenate([values, dense[0]])
    slow = 0.3 + fm.linear[at] @ x
    slow += sum(fm.factors[at[i]] @ fm.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert np.isclose(fm.raw(buckets, values, np.array([0, 3]), dense)[0], slow)


def test_isotonic_never_falls_and_fits():
    x, y = np.array([0.0, 1, 2, 3, 3, 4]), np.array([0.0, 1, 0, 1, 1, 1])
    xs, ys = toxicity.isotonic(x, y)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all()
    assert np.interp(1, xs, ys) == np.interp(2, xs, ys) == 0.5


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(1)
    rows = draw.random((2000, 3))
    y = ((rows[:, 0] > 0.5) & (rows[:, 1] > 0.5)).astype(float)
    model = toxicity.grow(rows, y)
    assert ((model.raw(rows) > 0) == (y == 1)).mean() > 0.99


def test_folded_tables_equal_the_network():
    draw = np.random.default_rng(2)
    rows = draw.integers(97, 123, (40, language.WINDOW)).astype(np.uint8)
    net = language.train(rows, np.arange(40) % 2, ["a", "b"], epochs=1)
    assert np.allclose(net.log_probabilities(rows, net.tables()), language.Scorer(net)._log_probabilities(rows), atol=1e-4)


def test_windows_cover_every_byte_once():
    for size in (0, 1, 253, 254, 256, 257, 1000):
        text = bytes(97 + i % 26 for i in range(size))
        rows, own = language.windows(text)
        whole = b"".join(r.tobytes()[: language.WINDOW - language.OVERLAP] for r in rows)
        assert whole[: min(size, len(whole))] == text[: len(whole)] and own.sum() >= size - language.OVERLAP


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, frame, odd_rows, module):
    docs = frame(odd_rows, CLASHING)
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 1, 0), (4, 1, 0), (5, 0, 1), (5, 1, 1), (None, 1, 1), (7, None, None), (6, 1, 0), (9, 0, 1), (12, 3, 3)],
        "doc_id long, quality int, toxic int",
    )
    model = module.fit(docs, labels)
    rows = docs.select("doc_id", module.score(docs, model).alias("s")).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["s"] <= 1 for r in rows)
    # No labels, no rows.
    for own in (docs, docs.limit(0)):
        model = module.fit(own, labels.limit(0))
        assert own.select(module.score(own, model).alias("s")).distinct().count() <= 1


def test_language_of_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows, CLASHING)
    net = language.fit(docs)
    rows = docs.select("doc_id", "text", language.predict(docs, net).alias("f")).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert r["f"]["lang_pred"] == ("en" if letters else "und")
    empty = docs.limit(0)
    assert language.fit(empty) is None
    assert docs.select(language.predict(docs, None).alias("f")).where("f.lang_pred <> 'und' or f.score <> 0").count() == 0

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from overlake.llm import packing, quality, queries, sql
from tests.llm import brute
from tests.llm.conftest import CLASHING

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(sql.statements()))
def test_query_like_its_statement(spark, con, name):
    df = queries.queries()[name](spark, SF)
    expected = con.sql(sql.statements()[name])
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    at = [expected.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(repr(tuple(r[i] for i in at)) for r in expected.fetchall())


def test_native_operators_run_no_python(spark):
    for name in ("op2_secrets", "op4_lines"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop")), name


def test_stages_like_plain_versions(spark):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    pairs = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = corpus_pipeline.keep_good(spark, docs, SF)
    assert good.columns == columns
    texts = docs.toPandas()
    scores = model.score(list(texts["text"]), texts["n_chars"].to_numpy(float))
    own = pairs(good)
    assert own == {k: t for k, t, s in zip(texts["doc_id"], texts["text"], scores, strict=True) if s >= quality.THRESHOLD}

    cut = corpus_pipeline.drop_lines(spark, good, SF)
    expected = brute.line_dedup(sorted(own.items()))
    kept = {k: t for k, t in expected.items() if t or not own[k] or t == own[k]}
    assert cut.columns == columns and pairs(cut) == kept
    assert cut.where("n_chars <> length(text)").count() == 0

    one = corpus_pipeline.drop_copies(spark, cut, SF)
    classes = brute.jaccard_classes(list(kept.items()))
    left = {k: t for k, t in kept.items() if classes[k][0] == k}
    assert one.columns == columns and pairs(one) == left

    clean = corpus_pipeline.drop_benchmark(spark, one, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute.contamination(list(left.items()), items)
    rest = {k: t for k, t in left.items() if not found[k][-1]}
    assert clean.columns == columns and pairs(clean) == rest

    packed = corpus_pipeline.pack(spark, clean, SF)
    assert packing.bins(packed).where("n_tokens > bin_length").count() == 0
    counted = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg({"n_tokens": "sum"}).toDF("doc_id", "n").collect()}
    assert counted == {k: len(t.split()) for k, t in rest.items() if t and t.split()}
    ran = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in ran.collect()} == {tuple(r) for r in packed.collect()}


def test_odd_rows_pass_every_stage(spark, frame, odd_rows):
    for rows in (odd_rows, []):
        docs = frame(rows, CLASHING)
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0

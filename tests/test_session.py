"""Settings that keep a task's share small, whatever the size of the input."""

import pandas as pd

from overlake.operators import dedupe
from overlake.session import RUNTIME_CONF, configure


def test_generated_methods_stay_below_what_the_jvm_compiles(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def test_a_task_reads_a_small_share(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "4m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def test_exchanges_are_dealt_finely_in_a_session_of_few_partitions(spark):
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < 200
    rows = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 3, None), (None, 3, "c")], "x int, y int, z string")
    least = dedupe(rows, ["x", "y"], place=["x"])
    # Neither fewer, whose sorts grow with the input, nor more than map tasks write without sorting.
    assert "hashpartitioning(x#" in (plan := least._jdf.queryExecution().executedPlan().toString()) and ", 200)" in plan
    found = sorted(least.collect(), key=repr)
    assert [tuple(r) for r in found] == [(1, 2, "a"), (1, 3, None), (None, 3, "c")]
    assert least.rdd.getNumPartitions() < 4  # joined again


def test_python_gets_bounded_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)]})

    found = [r.n for r in spark.range(5_000).coalesce(1).mapInPandas(sizes, "n long").collect()]
    assert sum(found) == 5_000 and max(found) <= 1_000


def test_explicit_settings_win(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "5m")
    try:
        assert configure(spark).conf.get(key) == "5m"
    finally:
        spark.conf.set(key, RUNTIME_CONF[key])

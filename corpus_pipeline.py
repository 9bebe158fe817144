"""A training-data pipeline: classify, remove repeated lines and near copies, decontaminate, pack.

Every stage takes the documents that its predecessor kept.  All but the last return the columns
of documents; the last returns the bin of every piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from overlake.llm import decontaminate, lines, ngram_join, packing, quality
from overlake.llm.tables import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs, model) >= quality.THRESHOLD)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur earlier; one that loses all its lines goes."""
    cut = lines.dedupe(docs)
    emptied = (F.col("line_stats.n_deleted") > 0) & (F.col("line_stats.n_deleted") == F.col("line_stats.n_lines"))
    cut = cut.where(~emptied)
    changed = F.col("line_stats.n_deleted") > 0
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 tie together."""
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words repeat the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document left."""
    return packing.assign(docs)


STAGES = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("copies", drop_copies),
    ("benchmark", drop_benchmark),
    ("packing", pack),
]

#: The stages are a model, similarity joins and a heuristic, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

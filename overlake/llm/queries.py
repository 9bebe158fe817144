"""The operators over the given tables, as registered queries with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from overlake.llm import alignment, decontaminate, language, lines, neighbours, ngram_join, packing, passages, quality, resampling, secrets, toxicity, urls
from overlake.llm.tables import held_out, stored, table
from overlake.session import fresh_path


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, by five-word shingles and a similarity of 0.8."""
    found = ngram_join.join(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "class_id", "n_links", "n_shingles")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    ledger = secrets.BlobLedger(spark, fresh_path(spark, "blob-ledger"))
    ledger.advance(docs)
    return secrets.digest(ledger.on_paths(docs, "doc_id"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt from labels whose key remainder is not 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), quality.score(docs, model).alias("score")
    ).withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = stored(neighbours.valid(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    index, share = neighbours.build(vectors), neighbours.fit_share(vectors, 5)
    found = neighbours.search(index, vectors.where("id % 50 = 0"), 5, share)
    return found.select("query_id", "rank", "vec_id", "score")


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its lines that occur earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedupe(docs).select("doc_id", "line_stats.*", "text")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.assign(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from those whose key remainder is not 1 of 3."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs)).alias("found")
    return docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), found).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words or more of every document, and the classes that they tie together."""
    found = passages.repeats(table(spark, sf_dir, "documents"))
    written = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        F.col("key").alias("doc_id"), "class_id", "n_words", "n_repeated", F.array_join(written, ",").alias("spans")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learnt from labels whose key remainder is not 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), toxicity.score(docs, model).alias("score")
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", decontaminate.matches(docs, table(spark, sf_dir, "benchmark")).alias("found"))
    n_words, n_hit = F.col("n_words"), F.col("n_hit")
    return (
        found.select("doc_id", "found.*")
        .withColumn("n_hit", decontaminate.covered(F.col("hits")))
        .select(
            "doc_id",
            n_words,
            n_hit,
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            decontaminate.contaminated(n_words, n_hit).alias("contaminated"),
            F.col("longest").alias("longest_match"),
        )
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies correspond in every document."""
    docs = table(spark, sf_dir, "documents")
    found = alignment.align(docs, alignment.fit(docs)).alias("found")
    groups = F.col("found.groups")
    return docs.select("doc_id", found).select(
        "doc_id",
        *[f"found.{c}" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"),
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark's words, and the rank of the tenth that is drawn."""
    docs = table(spark, sf_dir, "documents")
    found = resampling.resample(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", *[f"filtered.{c}" for c in ("host", "path", "rule", "verdict", "pattern")])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}

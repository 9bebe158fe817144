"""Helpers shared by the operators: reading, scratch tables, held-out rows, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from overlake.session import fresh_path


#: Rows that travel to Python together, unless the session says otherwise: texts can be long.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; bounds the session's batches for Python where it has not."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(key: Column, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``."""
    return F.crc32(key.cast("string").cast("binary")) % mod


def held_out(key: Column, mod: int, kept_back: int) -> Column:
    """Whether a row is kept back from learning; a null key is not."""
    return F.coalesce(remainder(key, mod) == kept_back, F.lit(False))


def recorded_size(docs: DataFrame) -> Column:
    """The number of characters that a document's metadata record, null where they don't."""
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, limit: int, mod: int = 4, kept_back: int = 2
) -> DataFrame:
    """(key, label, text, size) of at most ``limit`` labelled documents that learning may see.

    The documents with the smallest key hashes are taken, so that the sample is the same in
    every run.  Labels other than 0 and 1, null keys, and keys with differing labels are
    left out; of repeated documents one text is taken.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("key"), F.col(label).cast("int").alias("label"))
        .where("key is not null and label in (0, 1)")
        .where(~held_out(F.col("key"), mod, kept_back))
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .orderBy(F.xxhash64("key"), "key")
        .limit(limit)
        .select("key", "label")
    )
    row = F.struct(F.col("text"), recorded_size(docs).alias("size"))
    texts = docs.select(F.col("doc_id").alias("key"), row.alias("row"))
    # At most ``limit`` rows of two numbers: small whatever the input.
    return (
        texts.join(F.broadcast(chosen), "key")
        .groupBy("key", "label")
        .agg(F.min("row").alias("row"))
        .select("key", "label", "row.*")
    )

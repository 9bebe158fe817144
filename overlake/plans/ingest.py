"""Raw documents to silver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from overlake.plans.flatten import FLATTEN
from overlake.session import fresh_path
from overlake.sources.bronze import BronzeStore
from overlake.sources.ledger import FileLedger
from overlake.sources.raw import parse_documents, quarantine, read_raw, well_formed
from overlake.sources.silver import write_silver


@dataclass
class Ingested:
    processed: DataFrame
    """match_id of every document written"""
    errors: DataFrame
    """match_id and text of every unreadable document"""


def write_documents(docs: DataFrame, silver: str, mode: str = "full") -> Ingested:
    """Flatten parsed documents into the four silver tables.

    The parsed form is written once, as a nested Parquet table in the scratch folder;
    the four outputs each read only the leaves they need from it.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "parsed")
    docs.write.parquet(path)
    parsed = spark.read.schema(docs.schema).parquet(path)
    good = well_formed(parsed)
    # The match row comes last: once it is there, so is everything else of its revision.
    for name, flatten in sorted(FLATTEN.items(), key=lambda item: item[0] == "matches"):
        write_silver(flatten(good), silver, name, mode)
    return Ingested(good.select("match_id"), quarantine(parsed))


def transform(
    spark: SparkSession,
    raw: str,
    silver: str,
    mode: str = "full",
    since_days: float = 2,
) -> Ingested:
    """From a folder of document files.

    ``full`` reads all files and replaces silver; ``incremental`` reads the files
    changed within ``since_days`` and appends, staging keeping the newest revision.
    """
    docs = read_raw(spark, raw, None if mode == "full" else since_days)
    return write_documents(docs, silver, mode)


def transform_unseen(spark: SparkSession, raw: str, silver: str, ledger: FileLedger) -> int:
    """From a folder of document files those that the ledger does not hold, whatever their time;
    adds to silver and returns the number of files."""
    return ledger.take(raw, lambda paths: write_documents(read_raw(spark, paths), silver, "incremental"))


def transform_bronze(
    store: BronzeStore, silver: str, mode: str = "full", since_batch: int = 0, feed: str = "main"
) -> Ingested:
    """From the bronze store: all current documents, replacing silver, or, with
    ``incremental``, those of a feed's batches from ``since_batch`` on."""
    docs = store.current()
    if mode == "incremental":
        docs = docs.filter((F.col("feed") == feed) & (F.col("batch") >= since_batch))
    return write_documents(parse_documents(docs), silver, mode)

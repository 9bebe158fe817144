"""Raw match documents: scan, parse, quarantine, partition keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from overlake.functions import to_list_sql
from overlake.schemas import CORRUPT, MATCH_DOCUMENT

_READ_SCHEMA = T.StructType([*MATCH_DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])


def match_id_from(name: str) -> Column:
    return F.regexp_extract(name, r"([^/]+)[.]json$", 1)


def match_type_key() -> Column:
    return F.expr("lower(coalesce(info.match_type, 'unknown'))")


def year_key() -> Column:
    return F.expr(f"coalesce(substring(get({to_list_sql('info.dates')}, 0), 1, 4), 'unknown')")


def with_partition_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"match_type": match_type_key(), "year": year_key()})


def _modified_after(spark: SparkSession, since_days: float) -> str:
    """Cut-off in the session time zone, which is how the reader option is read."""
    cut = datetime.now(timezone.utc) - timedelta(days=since_days)
    row = spark.sql(
        "select date_format(timestamp_seconds(:s), \"yyyy-MM-dd'T'HH:mm:ss\") as t",
        args={"s": int(cut.timestamp())},
    ).first()
    return row.t


def read_raw_texts(
    spark: SparkSession, path: str | list[str], since_days: float | None = None
) -> DataFrame:
    """Unparsed documents under ``path``, all folders, as (name, file_modified,
    content), one row per file; ``since_days`` keeps files changed within so many days."""
    reader = (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
    )
    if since_days is not None:
        reader = reader.option("modifiedAfter", _modified_after(spark, since_days))
    return reader.load(path).select(
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.col("value").alias("content"),
    )


def read_raw(
    spark: SparkSession, path: str | list[str], since_days: float | None = None
) -> DataFrame:
    """Documents under ``path``: match_id, file_modified, the document's three parts,
    the text of unreadable ones, and the partition keys.

    A match is one small file, so many of them are packed into a task; the session's
    ``files.maxPartitionBytes`` and ``files.openCostInBytes`` say how many.
    """
    texts = read_raw_texts(spark, path, since_days)
    return parse_documents(texts, "content", match_id_from("name"), keep=("file_modified",))


def parse_documents(
    df: DataFrame,
    content: str = "content",
    match_id: str | Column = "match_id",
    parts: Sequence[str] = ("meta", "info", "innings"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse a text column holding one document per row, e.g. archive members.

    Parts left out of ``parts`` are skipped over and not built, but a document broken
    anywhere is still found.  A leaf of another shape than declared becomes NULL alone.
    The document is unfolded by a generator, which keeps a later filter from being pushed
    into a second parse.
    """
    fields = [f for f in _READ_SCHEMA if f.name in (*parts, CORRUPT)]
    doc = F.from_json(
        F.col(content),
        T.StructType(fields),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    identity = F.col(match_id) if isinstance(match_id, str) else match_id
    parsed = df.select(identity.alias("match_id"), *keep, F.col(content).alias("__text"), F.inline(F.array(doc)))
    # The parser notes the text also where only some leaf was odd; such a document has parts.
    nothing = " AND ".join(f"{p} IS NULL" for p in parts)
    unreadable = f"CASE WHEN {nothing} THEN coalesce({CORRUPT}, if(trim(coalesce(__text, '')) = '', '', NULL)) END"
    return with_partition_keys(parsed.withColumn(CORRUPT, F.expr(unreadable)).drop("__text"))


def well_formed(docs: DataFrame) -> DataFrame:
    """Documents of which something could be read."""
    return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(docs: DataFrame) -> DataFrame:
    """Unreadable documents with their text; the rest of the load is unaffected."""
    return docs.filter(F.col(CORRUPT).isNotNull()).select("match_id", CORRUPT)

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def inventory_of(paths: DataFrame, column: str = "path") -> DataFrame:
    """Files per match_type and year from paths relative to the layer's root, sorted;
    the first row, with both keys NULL, is the total over all files.

    Files above the partition folders count in the total only.
    """
    parts = F.split(F.col(column), "/")
    keyed = paths.select(
        F.size(parts).alias("depth"),
        F.regexp_replace(F.get(parts, F.lit(0)), "^match_type=", "").alias("match_type"),
        F.regexp_replace(F.get(parts, F.lit(1)), "^year=", "").alias("year"),
    )
    counted = keyed.groupBy(
        F.when(F.col("depth") >= 2, F.col("match_type")).alias("match_type"),
        F.when(F.col("depth") >= 2, F.col("year")).alias("year"),
    ).agg(F.count("*").alias("files"))
    total = counted.agg(
        F.lit(None).cast("string").alias("match_type"),
        F.lit(None).cast("string").alias("year"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
    )
    listed = counted.filter(F.col("match_type").isNotNull())
    return total.unionByName(listed).orderBy(
        F.asc_nulls_first("match_type"), F.asc_nulls_first("year")
    )


def partition_inventory(spark: SparkSession, root: str) -> DataFrame:
    """As :func:`inventory_of` for the files below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    marker = root.rstrip("/").rsplit("/", 1)[-1]
    relative = F.substring_index(F.col("path"), f"/{marker}/", -1)
    return inventory_of(files.select(relative.alias("path")))

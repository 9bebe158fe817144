from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def mode_of(
    df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None
) -> DataFrame:
    """Most frequent non-NULL value per key, ties to the smallest value.

    Two aggregations, (keys, value) and then keys, keep the state per group constant
    however many different values a key has.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("__n"))
    )
    best = F.min_by(F.col(value), F.struct(-F.col("__n"), F.col(value)))
    return counted.groupBy(*keys).agg(best.alias(alias or value))

"""Replace names by their canonical form through a mapping table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def canonicalize(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    raw: str,
    outputs: Mapping[str, str],
) -> DataFrame:
    """Look ``column`` up in ``mapping[raw]``; ``outputs`` says which column of ``df``
    (created or replaced) takes which mapping column, keeping the old value where the
    map has none.

    No broadcast hint: the planner broadcasts the map when its size allows, and joins
    by shuffle when a user supplies a large one.
    """
    names = {target: f"__to_{i}" for i, target in enumerate(outputs)}
    lookup = mapping.select(
        F.col(raw).alias("__raw"),
        *[F.col(source).alias(names[t]) for t, source in outputs.items()],
    )
    joined = df.join(lookup, df[column] == lookup["__raw"], "left")
    replaced = {
        t: F.coalesce(F.col(names[t]), F.col(t if t in df.columns else column))
        for t in outputs
    }
    return joined.withColumns(replaced).drop("__raw", *names.values())

"""Data checks.  Each returns the violating rows; none means the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns is NULL."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.filter(bad)


def violation_counts(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """One row (name, failures) per SQL condition, all counted in one pass over ``df``;
    unknown is no violation."""
    counts = df.agg(*[F.expr(f"count_if({cond}) AS `{name}`") for name, cond in conditions.items()])
    return counts.unpivot([], list(conditions), "name", "failures")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (column_name, failures) per column, all counted in one pass."""
    counts = violation_counts(df, {c: f"`{c}` IS NULL" for c in columns})
    return counts.withColumnRenamed("name", "column_name")


def unique(df: DataFrame, key: str | Column | Sequence[str]) -> DataFrame:
    """Values of a column, expression or column list that occur more than once.

    NULL is not a value, so it never counts as a duplicate.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    named = df.select(
        *[c.alias(k if isinstance(k, str) else f"value_{i}") for i, (k, c) in enumerate(zip(keys, cols))]
    )
    return (
        named.na.drop("any")
        .groupBy(*named.columns)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list; NULL is accepted."""
    return df.filter(~F.col(column).isin(*values))


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def rule(df: DataFrame, must_hold: Column) -> DataFrame:
    """Rows for which the rule is false; unknown counts as holding."""
    return df.filter(~must_hold)

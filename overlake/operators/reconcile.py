"""Compare computed figures with published ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def reconcile(
    actual: DataFrame, expected: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """One row per actual row that has published figures: per column the actual and
    published value with their difference, and a status that is OK only when every
    published column agrees.  Players without any published figure are left out.

    ``expected`` has ``key``, any of ``columns`` and optionally ``note``.
    """
    ref = expected.select(
        F.col(key),
        *[F.col(c).alias(f"expected_{c}") for c in columns],
        *([F.col("note")] if "note" in expected.columns else []),
    ).filter(F.col(f"expected_{columns[0]}").isNotNull())
    joined = actual.join(ref, key)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"expected_{c}"))
    out = [F.col(key)]
    for c in columns:
        out += [
            F.col(c),
            F.col(f"expected_{c}"),
            (F.col(c) - F.col(f"expected_{c}")).alias(f"{c}_diff"),
        ]
    out.append(F.when(same, "OK").otherwise("MISMATCH").alias("status"))
    if "note" in expected.columns:
        out.append(F.col("note"))
    return joined.select(*out)

"""Top-n lists and top-k shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from overlake.functions import named, ratio


def top_n(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """Ordered list, cut to ``n`` rows.  Per-task heaps merge into one of size ``n``,
    so no full sort takes place; ``n=None`` keeps all rows."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def top_k_share(
    df: DataFrame, group: str, entity: str, measure: str, k: int = 3
) -> DataFrame:
    """Share of ``measure`` held by the ``k`` largest entities of each group.

    ``df`` has one row per (group, entity).  The ranking is limited to ``k`` rows per
    group before its exchange and the total is a partial aggregate, so a group with
    very many entities is never gathered in one task.
    Returns group, total, top, pct, names; ties rank by entity name.
    """
    rank = f"row_number() OVER (PARTITION BY `{group}` ORDER BY `{measure}` DESC NULLS LAST, `{entity}` ASC NULLS LAST)"
    ranked = df.withColumn("__rank", F.expr(rank)).filter(f"__rank <= {int(k)}")
    label = f"concat(`{entity}`, ' (', `{measure}`, ')')"
    best = ranked.groupBy(group).agg(
        *named(
            top=f"sum(`{measure}`)",
            __l=f"array_sort(collect_list(named_struct('rank', __rank, 'label', {label})))",
        )
    )
    totals = df.groupBy(group).agg(F.sum(measure).alias("total"))
    return totals.join(best, group).select(
        group,
        "total",
        "top",
        ratio("top", "total", 1, times=100).alias("pct"),
        F.expr("array_join(__l.label, ', ') AS names"),
    )

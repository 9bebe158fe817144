"""Wide pivot over ranges by conditional aggregation, in a single pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column

from overlake.functions import named


def phase_pivot(
    position: str, phases: Mapping[str, tuple], measures: Mapping[str, str]
) -> list[Column]:
    """Aggregates ``<phase>_<measure>``: the sum of each measure, a SQL expression, over
    the rows whose ``position`` lies in the phase's closed range; 0 where there is none."""
    return named(
        **{
            f"{p}_{name}": f"sum(CASE WHEN {position} BETWEEN {lo} AND {hi} THEN {m} ELSE 0 END)"
            for p, (lo, hi, *_) in phases.items()
            for name, m in measures.items()
        }
    )

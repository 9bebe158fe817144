"""Generic operators: DataFrame in, DataFrame out, parameterised by column names."""

from overlake.operators.modes import mode_of
from overlake.operators.names import canonicalize
from overlake.operators.phases import phase_pivot
from overlake.operators.quality import (
    accepted_values,
    not_null,
    null_counts,
    relationships,
    rule,
    unique,
    violation_counts,
)
from overlake.operators.ranking import top_k_share, top_n
from overlake.operators.reconcile import reconcile
from overlake.operators.versions import (
    classify_revisions,
    dedupe,
    latest_by,
    revision_stats,
    upsert_by_revision,
)

__all__ = [n for n in dir() if not n.startswith("_")]

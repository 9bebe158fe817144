"""Ball-by-ball match analytics expressed as Spark DataFrame plans."""

from overlake.session import configure, scratch_dir
from overlake.plans.tables import MatchTables, Seeds, Silver

__all__ = ["MatchTables", "Seeds", "Silver", "configure", "scratch_dir"]

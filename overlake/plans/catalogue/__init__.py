"""The query catalogue: parameterised functions ``(tables, ...) -> DataFrame``.

Ordered lists place NULL last in both directions and end their order with a unique
key, so equal values never make a result depend on how rows arrive.
"""

from overlake.plans.catalogue import audit, coverage, leaders, matches, player, season, sql_functions, team

__all__ = ["audit", "coverage", "leaders", "matches", "player", "season", "sql_functions", "team"]

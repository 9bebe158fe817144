"""SQL statements giving the expected result of each registered query.

They are written for a single-node SQL engine over the same tables and share no code
with the Spark plans: the batting innings, for one, are built here from three separate
cases.
"""

from oracle.statements import statements

__all__ = ["statements"]

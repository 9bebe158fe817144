"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Each module holds one operator with its
own interface; ``queries`` registers them over the given tables and ``sql`` has the statements
that check them where SQL can express the result.
"""

"""Operators of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage. Each operator is a module of its
own; `queries` holds the registered queries and their SQL.
"""

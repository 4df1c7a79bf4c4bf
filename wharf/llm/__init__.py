"""Operators of a training-data pipeline over a `documents` table.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; `queries` holds the registered queries that
apply them to whole tables.
"""

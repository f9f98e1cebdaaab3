"""Operators of a training-data pipeline over document, page and label tables.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` holds the registered queries.
"""

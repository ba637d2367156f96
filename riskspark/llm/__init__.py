"""Operators of a training-data pipeline (documents, pages, conversations).

Nothing else in the library imports this subpackage; the registered queries
are in :mod:`riskspark.llm.queries`.
"""

"""Operators of a training-data pipeline over documents, embeddings and pages.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` binds them to the given tables.
"""

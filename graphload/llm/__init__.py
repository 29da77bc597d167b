"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries`` registers one query for each.
"""

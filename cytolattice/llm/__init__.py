"""Operators for training-data pipelines: documents, pages and embeddings.

Every module holds one operator as plain functions from DataFrames to DataFrames; ``queries`` binds them to the
test tables.  Nothing else in the library imports this sub-package.
"""

"""Operators for large training-data pipelines (documents, pages, embeddings).

Nothing else in the library imports this subpackage; it imports only general
helpers (session folders) from the rest.
"""

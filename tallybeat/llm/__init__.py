"""Operators for training data: documents and embeddings in, cleaned, scored and encoded data out.

Each module holds one operator; ``queries`` applies them to the given tables and ``twins``
states in SQL what SQL can state. Nothing else in the library imports this subpackage.
"""

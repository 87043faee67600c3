"""Operators for training-data pipelines: text, archives, vectors and conversations.

Nothing else in :mod:`causeway` imports this subpackage; it can be removed as a whole.
"""

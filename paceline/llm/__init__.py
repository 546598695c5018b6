"""Operators of a training-data pipeline over documents, conversations and labels.

Nothing else in the library imports this subpackage. ``queries`` binds each operator to its table.
"""

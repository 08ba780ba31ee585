"""Operators for large training-data pipelines.

Every module holds one operator with its registered query; ``queries`` loads
them all.  Nothing outside this package imports it.
"""

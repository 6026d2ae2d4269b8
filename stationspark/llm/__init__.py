"""Operators of a training-data pipeline, each a module of its own.

Nothing else in the library imports this subpackage.
"""

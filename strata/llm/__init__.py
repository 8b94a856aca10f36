"""Operators for preparing training data, each a Spark job of its own.

Nothing else in the library imports this subpackage.
"""

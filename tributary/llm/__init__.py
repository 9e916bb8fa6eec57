"""Operators for training-data pipelines.

Self-contained: nothing else in the library imports this subpackage. Each
module holds one operator with its own general interface; ``queries`` binds
them to the driver tables.
"""

"""Operators for training-data pipelines over large text corpora.

Nothing else in the library imports this subpackage. Each module holds one operator; `catalog`
registers their queries.
"""

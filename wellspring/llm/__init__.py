"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; the thin
``opN_`` queries and their SQL are in ``catalog.py``.  Nothing else in the
library imports this subpackage.
"""

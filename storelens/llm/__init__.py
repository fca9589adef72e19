"""Operators for preparing training data at scale.

Each module holds one operator with a general interface; the registered
queries are thin calls in ``queries.py``. Nothing else in the library
imports this subpackage.
"""

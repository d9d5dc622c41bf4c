"""Operators of a training-data pipeline over tables of documents and pages.

Nothing outside this package imports it; `queries.py` holds what is registered.
"""

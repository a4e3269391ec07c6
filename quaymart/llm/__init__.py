"""Operators of a training-data pipeline over tables of documents and pages.

Each operator takes a DataFrame with at least the columns it names, ignores all
others, and returns a DataFrame of its own columns.  ``queries`` applies them to
the provided tables.
"""

"""DataFrame operators that turn raw operational tables into a small star schema.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``-> Column``) function
over public PySpark API.  Reading and writing lives in :mod:`quaymart.sources`.
"""

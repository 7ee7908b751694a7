"""Operators for large-scale training-data preparation.

Each module holds one operator with a general interface; ``queries`` applies
them to the driver's tables and ``sql`` holds the DuckDB statements for those
that SQL can express.  Nothing outside this package imports it.
"""

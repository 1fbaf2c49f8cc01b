"""Operators for preparing large-scale training data.

Nothing outside this package imports it.  Every operator is a function from
DataFrames to a DataFrame; ``queries.py`` holds the contract queries over the
shared tables.
"""

"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and column names and returns DataFrames; ``queries`` holds the
registered queries and their SQL.
"""

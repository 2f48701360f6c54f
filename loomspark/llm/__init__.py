"""Operators that prepare training data at corpus scale.

Every operator takes DataFrames and column names and returns DataFrames; ``registry`` holds the thin
queries that apply them to whole tables. Nothing outside this subpackage imports it.
"""

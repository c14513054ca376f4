"""Operators for large text corpora: extraction, scoring, de-duplication, packing.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; ``queries.py`` registers one query per operator.
"""

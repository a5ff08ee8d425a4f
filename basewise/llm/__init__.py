"""Training-data operators: extraction, search, dedup, packing, scoring.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames, reads only the columns it names, and ignores all others.
"""

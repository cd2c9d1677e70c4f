"""Training-data operators: tokenization, quality, privacy, packing, deduplication, fixity and vector search.

Nothing outside this subpackage imports it. Every operator takes a DataFrame plus the names of the columns it reads, ignores
further columns (also ones whose names clash with its outputs) and returns a DataFrame.
"""

"""Training-data operators: quality, deduplication, decontamination, tokens, scoring, sharding.

Every operator is a function over DataFrames with its own parameters; `queries` holds the thin
registered queries and `oracle` their DuckDB statements.  Nothing outside this package imports it.
"""

"""The query catalogue over the given tables, with its reference SQL."""

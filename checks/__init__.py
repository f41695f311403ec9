"""The operators run over the given tables, with the same results stated in SQL."""

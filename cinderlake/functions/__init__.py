"""Column functions: every one is a Spark expression, none is a Python UDF."""

"""Column functions: every one is a built-in expression, none is a Python UDF."""

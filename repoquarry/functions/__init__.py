"""Column functions: every one is a native Spark SQL expression."""

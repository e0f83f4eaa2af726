"""Column builders; every one is a plain built-in Spark expression."""

"""Column expressions (built-in Spark functions) and hashing."""

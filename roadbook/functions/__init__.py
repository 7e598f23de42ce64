"""Column expressions; every one of them is built from Spark's own functions."""

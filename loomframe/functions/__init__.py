"""Column functions: built from Spark's own expressions, no Python per row."""

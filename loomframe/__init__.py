"""Spark-first analytics operators: pure functions from DataFrame to DataFrame."""

"""Operators for training-data pipelines, one module each; their queries are in ``queries.py``."""

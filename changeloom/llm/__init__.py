"""Operators for training-data pipelines, their queries and reference SQL. Nothing outside imports this."""

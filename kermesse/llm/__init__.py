"""Operators of a training-data pipeline, one module each; `queries` binds them to the given tables."""

"""Scalar, table and aggregate functions (built-in expressions first)."""

"""Scalar, table and aggregate functions."""

"""Scalar functions and aggregates."""

"""Scalar and array functions: Column in, Column out, no Python per row."""

"""Composite operators: dimensions, keys, validation, fact, constraints."""

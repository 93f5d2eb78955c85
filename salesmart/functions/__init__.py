"""Column-level helpers built from Spark's built-in functions."""

from salesmart.functions import dates, numeric, text

__all__ = ["dates", "numeric", "text"]

"""Data conformance on Spark: messy text tables to a typed, deduplicated, checked model."""

from .operators.lookup import ConformError

__all__ = ["ConformError"]
__version__ = "0.1.0"

"""Column-level functions: text, parsing, names."""

from . import names, parse, text

__all__ = ["names", "parse", "text"]

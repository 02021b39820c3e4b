"""Operators for training data: one module per operator, their queries in `queries`."""

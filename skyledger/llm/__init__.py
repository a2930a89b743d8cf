"""Operators that prepare training data. Nothing outside this package imports it, but for the driver contract."""

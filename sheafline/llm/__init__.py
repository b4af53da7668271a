"""Operators for text and record collections used as training data. Nothing outside this package imports it."""

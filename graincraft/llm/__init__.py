"""Operators for text and record collections used as training data. Nothing else in the library imports this package."""

"""Operators for text collections used as training data; nothing outside this package imports it."""

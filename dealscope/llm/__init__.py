"""Operators that turn a document table into training data. Nothing outside this package imports them."""

"""Operators for the preparation of training data; nothing outside this package imports it."""

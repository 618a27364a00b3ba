"""Operators of a training-data pipeline over text, pages and vectors. Nothing else in the library imports them."""

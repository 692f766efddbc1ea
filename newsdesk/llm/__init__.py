"""Operators of a training-data pipeline on tables of documents; nothing else in the library needs them."""

"""Polling as micro-batches over a landing folder."""

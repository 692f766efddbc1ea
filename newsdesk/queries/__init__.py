"""Registered queries: every operator on the given tables, next to the SQL that must agree with it."""

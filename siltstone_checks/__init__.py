"""Queries over the given tables, and the SQL that each result is compared with."""

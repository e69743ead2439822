"""Joins, aggregates, ranks and filters over DataFrames."""

"""Relational operators: joins, windows, aggregates, merges, models."""

"""Queries over the tables at hand, with their SQL."""

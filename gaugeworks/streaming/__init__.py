"""Incremental arrivals."""

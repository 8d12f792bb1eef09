"""Readers: period-named file sets and target schemas."""

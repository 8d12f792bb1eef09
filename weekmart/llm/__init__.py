"""Operators for preparing training text: archives, near-duplicates, scans,
filters, mixing, decontamination and substring removal.  Nothing outside this
subpackage imports it."""

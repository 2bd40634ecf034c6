"""Operators for large text corpora: filters, duplicates, packing, scans, archives."""

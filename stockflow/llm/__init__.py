"""Operators for large text corpora (near-duplicates, scans, packing, sharding).

Nothing else in the library imports this subpackage.
"""

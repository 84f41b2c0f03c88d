"""Training-data operators: packing, scoring, deduplication, cleaning and scans.

Nothing outside this subpackage imports it; it can be deleted without touching the rest.
"""

"""Training-data operators: dedup, scans, search, packing.

Nothing outside this subpackage imports it; ``queries.py`` lists its queries.
"""

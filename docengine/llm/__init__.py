"""Training-data operators: deduplication, extraction, scoring, mixing and output.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""

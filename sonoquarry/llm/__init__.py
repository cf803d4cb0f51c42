"""Training-data operators: deduplication, filtering, scanning, formatting and tokenisation.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""

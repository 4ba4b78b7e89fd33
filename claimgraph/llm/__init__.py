"""Training-data operators: deduplication, filtering, mixing, packing, search and archives.

Nothing outside this subpackage imports it.
"""

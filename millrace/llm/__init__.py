"""Training-data operators: tokenising, chat formatting, search, dedup, filters, packing.

Nothing outside this subpackage imports it.
"""

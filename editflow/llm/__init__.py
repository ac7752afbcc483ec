"""Operators for preparing training text: deduplication, packing, filtering, scoring and scanning.

Nothing outside this folder imports it.
"""

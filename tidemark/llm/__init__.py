"""Operators for preparing training text: filters, deduplication, archives, packing and formatting."""

"""Operators for preparing training text: extraction, cleaning, duplicates, counting, packing."""

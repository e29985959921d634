"""Operators for preparing training text: dedup, mixing, language, packing, files."""

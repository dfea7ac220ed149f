"""Operators that prepare training text: cleaning, duplicate search, mixing, packing."""

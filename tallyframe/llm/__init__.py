"""Operators for preparing training text: cleaning, screening, de-duplication, mixing and packing."""

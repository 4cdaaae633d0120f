"""Operators for preparing training text: extraction, filtering, deduplication, decontamination, mixing and search."""

"""Operators for preparing training text: deduplication, scoring, decontamination, token output."""

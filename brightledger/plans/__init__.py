"""Bindings of operators to tables, each paired with its check query, and the layered pipeline."""

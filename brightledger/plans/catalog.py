"""Loads every query module so that the registry is complete."""

from . import q_changes, q_medallion, q_quality, q_relational, q_scalar, q_semi, q_series, q_sources, q_text, q_windows  # noqa: F401
from .registry import REGISTRY  # noqa: F401

"""The full query catalog: importing this module registers every query."""

from __future__ import annotations

from rxlake.plans import q_board, q_core, q_dirty, q_io, q_series, q_severity, q_triage  # noqa: F401
from rxlake.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]

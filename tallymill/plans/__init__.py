"""Queries over the input tables, grouped by what they exercise."""

from tallymill.plans import columns, events, functions, grouping, relational, setops, sinks, spans, streams, summaries, upkeep, windows  # noqa: F401
from tallymill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

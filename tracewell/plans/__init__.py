"""All registered queries."""

from tracewell.plans.registry import ORACLES, QUERIES
from tracewell.plans import alarms, panels, requests, spans, streams, topology, trees  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries and their SQL."""

from millrace.plans import basics, cases, matching, streamed, timed  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""The registered queries."""

from millrace.plans import basic, flows, related, streams, timed
from millrace.plans.registry import QUERIES

__all__ = ["QUERIES", "basic", "flows", "related", "streams", "timed"]

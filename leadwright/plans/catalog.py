"""All registered queries."""

from leadwright.plans import queries_features, queries_models, queries_sources  # noqa: F401  (they register themselves)
from leadwright.plans.registry import ORACLES, QUERIES, forget_stages

__all__ = ["ORACLES", "QUERIES", "forget_stages"]

"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from liftwise.plans import (  # noqa: F401
    feature_queries,
    learner_queries,
    lift_queries,
    monitor_queries,
    rank_queries,
    source_queries,
)
from liftwise.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Importing this module registers every query."""

from . import (  # noqa: F401
    audit_queries,
    dataset_queries,
    evaluation_queries,
    model_queries,
    monitoring_queries,
    scoring_queries,
    strategy_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401

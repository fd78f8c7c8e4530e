"""Queries over the test tables and the SQL they must agree with."""

from threadlens.checks import (  # noqa: F401  (importing registers the queries)
    cleaning,
    corpus,
    engagement,
    features,
    joining,
    metrics,
    models,
    reshaping,
    sampling,
    sentiment,
)
from threadlens.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

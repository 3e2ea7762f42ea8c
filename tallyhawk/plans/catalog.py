"""All registered queries and their SQL counterparts."""

from tallyhawk.plans import queries_data, queries_evaluation, queries_features, queries_models  # noqa: F401
from tallyhawk.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

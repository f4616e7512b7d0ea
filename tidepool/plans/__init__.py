"""Registered queries: import every plan module so its queries register."""

from tidepool.plans.registry import REGISTRY, Query, query  # noqa: F401
from tidepool.plans import reporting, logs, profiling, features, evaluation, ingestion, sampling, modelling, marts, storage, churn  # noqa: F401

__all__ = ["REGISTRY", "Query", "query"]

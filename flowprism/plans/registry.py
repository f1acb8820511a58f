"""Imports every query module so their ``@register`` calls fill ``QUERIES`` / ``ORACLES``."""

from __future__ import annotations

import importlib

from flowprism.plans.base import ORACLES, QUERIES

_MODULES = ["cleaning_queries", "evaluation_queries", "feature_queries", "balance_queries", "model_queries"]


def load():
    for m in _MODULES:
        importlib.import_module(f"flowprism.plans.{m}")
    return QUERIES, ORACLES

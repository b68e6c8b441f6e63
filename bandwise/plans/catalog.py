"""Query catalog: one Spark query per operator group, with its DuckDB oracle.

Every query reads the driver tables of an ``sf_dir`` in full (no id subsets,
no row caps except where the limit is the operator itself) and returns a
DataFrame whose floating columns are rounded to 6 decimals.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _load_all():
    # Import query modules for their registration side effect.
    for mod in ("q_evaluate", "q_profile", "q_split", "q_encode", "q_scorecard", "q_stats", "q_media",
                "q_text", "q_explain", "q_models", "q_checks", "q_udf", "q_relational", "q_streaming"):
        importlib.import_module(f"bandwise.plans.{mod}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)

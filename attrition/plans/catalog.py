"""Registry of named queries: a Spark plan and, where SQL can say it, its
DuckDB oracle. ``__spark_entry__`` only wires this registry out.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    key: str
    fn: QueryFn
    oracle: str | None
    ref: str  # SURVEY inventory id


REGISTRY: dict[str, Query] = {}
MODULES = ["q_clean", "q_quality", "q_sampling", "q_store", "q_aggregate", "q_evaluate", "q_drift", "q_io", "q_monitor", "q_ml", "q_stream"]


def query(key: str, ref: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, oracle, ref)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    import importlib
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")
    return REGISTRY

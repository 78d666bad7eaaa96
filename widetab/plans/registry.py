"""Query registry: name → (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, operators: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(operators))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from widetab.plans import (  # noqa: F401
        q_profile, q_features, q_sampling, q_metrics, q_ensemble, q_online, q_models, q_boosting, q_edges,
    )
    return REGISTRY

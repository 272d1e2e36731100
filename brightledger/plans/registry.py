"""Registry of runnable queries and their check queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .relations import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a builder under an operator id, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return register

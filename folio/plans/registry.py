"""Query registry: one Spark plan + one DuckDB oracle per operator key.

A plan is ``fn(fx: Fixtures) -> DataFrame``; the oracle is SQL text that DuckDB
runs against the raw tables (fixtures are inlined as a ``WITH`` chain).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folio.sources.fixtures import Fixtures, duckdb_with

PLANS: dict[str, Callable[[Fixtures], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plan(key: str, oracle: str | None = None):
    def deco(fn):
        if key in PLANS:
            raise ValueError(f"duplicate key {key}")
        PLANS[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def W(*fixtures: str) -> str:
    """``WITH`` prefix for the named fixtures, ending with a comma so that the
    oracle can add its own CTEs."""
    return duckdb_with(*fixtures).rstrip() + ",\n"


def as_query(fn: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Fixtures(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def load_all() -> None:
    from folio.plans import (admission_plans, case_plans, curation_plans,  # noqa: F401
                             discovery_plans, index_plans, maintenance_plans, parse_plans, scalar_plans,
                             stream_plans)

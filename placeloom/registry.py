"""Names of the location queries, gathered from the modules in ``plans``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import city, records

PLANS = [city, records]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for plan in PLANS for name, f in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for plan in PLANS for name, sql in plan.ORACLES.items()}

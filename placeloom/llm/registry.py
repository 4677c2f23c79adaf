"""Names of the corpus queries. Each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q

_NAMES = {n: getattr(q, n) for n in dir(q) if n.startswith("op") and callable(getattr(q, n))}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(sorted(_NAMES.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(q.ORACLES)

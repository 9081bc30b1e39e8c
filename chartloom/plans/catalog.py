"""Every registered query of the core library, with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartloom.plans import relational


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(relational.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(relational.ORACLES)

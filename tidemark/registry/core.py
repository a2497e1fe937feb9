"""The registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.tables import Tables
from tidemark.session import runtime_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with runtime_conf(spark):
                return fn(Tables(spark, sf_dir.rstrip("/")))

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


def half_up(numerator: str, denominator: str, digits: int = 2, scale: int = 1) -> str:
    """SQL for ``scale * numerator / denominator`` of two non-negative integers, rounded half up."""
    num = f"(CAST({numerator} AS HUGEINT) * {scale * 10 ** digits})"
    den = f"CAST({denominator} AS HUGEINT)"
    return f"(CAST((2 * {num} + {den}) // (2 * {den}) AS DOUBLE) / {10 ** digits})"


def cents(amount: str) -> str:
    """SQL for a two-decimal double amount as an integer number of cents."""
    return f"CAST(round({amount} * 100) AS BIGINT)"

"""Reading the given tables, and the registry of this subpackage's queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name."""

    def register(plan: Plan) -> Plan:
        QUERIES[plan.__name__] = Query(plan, sql)
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

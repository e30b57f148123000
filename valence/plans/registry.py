"""Names the queries, with the SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, folder) -> DataFrame`` under its own name."""

    def add(build: Query) -> Query:
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return build

    return add

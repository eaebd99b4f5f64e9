"""Named queries, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return register

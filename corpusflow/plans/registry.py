"""Queries over the test tables by name, and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusflow.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (read) -> DataFrame under its name; read(table) gives a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add

"""How queries and their SQL twins are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, with DuckDB SQL where it can express them."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register a function (tables) -> DataFrame under its name; ``tables(name)`` reads a table."""

        def put(f):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

            run.__name__, run.__doc__ = f.__name__, f.__doc__
            self.queries[f.__name__] = run
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return put

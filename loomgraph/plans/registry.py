"""Registration of queries beside their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and oracles of one module, in the order written."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[name or f.__name__] = f
            if sql:
                self.oracles[name or f.__name__] = sql
            return f

        return add

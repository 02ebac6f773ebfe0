"""Query table: name -> DataFrame builder, and name -> SQL of equal meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekgrid.plans.sql import with_tables

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` may refer to the panel tables by name."""

    def add(builder: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = builder
        if sql is not None:
            SQL[name] = with_tables(sql)
        return builder

    return add

"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scenequarry.plans.derived import ctes, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, tables: str = "", sql: str | None = None, then: str = ""):
    """Register ``fn(load)``: ``load(table_name)`` gives a derived table.

    ``sql`` is the DuckDB text that follows the WITH clause of ``tables``; ``then`` adds further CTEs.
    """

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda t: table(spark, sf_dir, t))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            head = ctes(*tables.split()) if tables else ""
            extra = (", " if head else "WITH ") + then.strip() if then.strip() else ""
            ORACLES[name] = f"{head}{extra}\n{sql.strip()}".strip()
        return fn

    return deco

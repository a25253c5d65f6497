"""Registered queries over the driver tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from chordgrid.plans.views import Views, with_ctes

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *ctes: str) -> Callable:
    """Registers a function of :class:`Views` as a query, with its SQL behind the named CTEs."""

    def add(f: Callable[[Views], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[name] = with_ctes(sql, *ctes) if ctes else sql
        return f

    return add


from chordgrid.plans import chart_queries, core_queries, data_queries, io_queries, more_queries, train_queries  # noqa: E402, F401

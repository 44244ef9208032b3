"""Every operator as a runnable query over the test tables, with its DuckDB counterpart.

Each module has ``QUERIES`` (name -> function of a session and a table folder) and ``ORACLES``
(name -> SQL). A query without SQL is checked by the tests instead.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textward.plans.catalog import (
    curation,
    drift,
    evaluation,
    features,
    monitoring,
    profiling,
    scoring,
    selecting,
    sources,
    terms,
)
from textward.plans.session import ship_package

_MODULES = (
    sources,
    features,
    curation,
    profiling,
    terms,
    scoring,
    evaluation,
    drift,
    selecting,
    monitoring,
)

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf)

    return run


def all_queries() -> dict[str, Query]:
    return {name: _shipped(fn) for m in _MODULES for name, fn in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

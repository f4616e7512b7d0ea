"""Named queries over the driver tables, each with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is ANSI SQL over the
pre-registered views (region nation customer ... conversations).  Queries with
no SQL form register ``sql=None`` and are checked by row count and by pytest
properties instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidepool.shipping import ship

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: tuple[str, ...] | str = (), sql: str | None = None):
    """Register ``fn`` under ``name`` with its inventory ids and oracle SQL."""
    if isinstance(ids, str):
        ids = tuple(i.strip() for i in ids.split(",") if i.strip())

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Query(name, run, sql.strip() if sql else None, tuple(ids))
        return fn

    return deco

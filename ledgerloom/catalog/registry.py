"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.star import Star
from .star_sql import with_views

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, key: str, views: str = "", sql: str | None = None, extra: str = ""):
        """Register ``fn(star)``; ``sql`` reads the named star views, ``extra`` holds further CTEs."""

        def wrap(fn: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key] = lambda spark, root: fn(Star(spark, root))
            if sql is not None:
                self.oracles[key] = with_views(views, sql, extra)
            return fn

        return wrap

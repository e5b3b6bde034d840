"""Named queries: a Spark builder and, where SQL can say it, the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfwise.plans.views import Views, sql_with_views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Views], DataFrame]
    sql: str | None = None


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, name: str, sql: str | None = None):
        """Register the decorated builder under `name`."""

        def wrap(build: Callable[[Views], DataFrame]):
            if name in self.queries:
                raise ValueError(f"query {name!r} is registered twice")
            self.queries[name] = Query(name, build, sql and sql_with_views(sql))
            return build

        return wrap


REGISTRY = Registry()

"""Where query modules enter a name, a Spark callable and its check SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.checks: dict[str, str] = {}

    def add(self, name: str, check: str | None = None):
        def enter(fn: Query) -> Query:
            if name in self.queries:
                raise KeyError(f"{name} is registered twice")
            self.queries[name] = fn
            if check is not None:
                self.checks[name] = check
            return fn
        return enter

    def merge(self, *others: "Registry") -> "Registry":
        for o in others:
            for name, fn in o.queries.items():
                self.add(name, o.checks.get(name))(fn)
        return self

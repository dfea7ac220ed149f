"""Registry of queries with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its own name; ``covers`` lists survey ids."""

    def keep(build: Build) -> Build:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), build, sql)
        return build

    return keep

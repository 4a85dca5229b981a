"""Registry of named checkable queries: a Spark builder plus its DuckDB twin SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None  # None: no SQL twin (rows-only check, tested against brute force)
    ids: str  # SURVEY inventory ids covered


REGISTRY: dict[str, Entry] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, ids)
        return fn
    return deco

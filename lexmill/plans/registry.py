"""Named queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.plans.standins import VIEW_SQL, Tables

Builder = Callable[[Tables], DataFrame]

_BUILDERS: dict[str, Builder] = {}
_SQL: dict[str, str] = {}

MODULES = (
    "text_queries",
    "table_queries",
    "ledger_queries",
    "nested_queries",
    "stage_queries",
    "document_queries",
    "review_queries",
    "search_queries",
    "mirror_queries",
    "stream_queries",
)


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in _BUILDERS:
            raise ValueError(f"query {name} is registered twice")
        _BUILDERS[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"lexmill.plans.{module}")


def _views_in(sql: str, found: list[str]) -> list[str]:
    for name in VIEW_SQL:
        if re.search(rf"\b{name}\b", sql) and name not in found:
            _views_in(VIEW_SQL[name], found)
            found.append(name)
    return found


def with_views(sql: str) -> str:
    """Prepend the stand-in views that the statement mentions."""
    ctes = [f"{name} AS ({VIEW_SQL[name]})" for name in _views_in(sql, [])]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _bind(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Tables(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _bind(build) for name, build in _BUILDERS.items()}


def all_sql() -> dict[str, str]:
    _load()
    return {name: with_views(sql) for name, sql in _SQL.items()}

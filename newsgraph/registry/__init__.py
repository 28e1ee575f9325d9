"""Registered queries and their checking SQL, one module per part of the inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsgraph.registry import files, found, graph, tables, texts

MODULES = [files, texts, found, graph, tables]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: entry[0] for module in MODULES for name, entry in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: entry[1] for module in MODULES for name, entry in module.QUERIES.items() if entry[1]}


def forget_staged() -> None:
    """Drop the session's memory of staged tables, so that the next query computes its inputs again."""
    for staged in (found.found, found.linked, graph.kept_relations, graph.streamed, graph._run):
        staged.cache_clear()

"""All queries of the core by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jangbu.plans import cleaning, curation, drift, files, history, market, outputs, profile, references, relations, selection

MODULES = (curation, market, files, history, outputs, cleaning, relations, references, drift, selection, profile)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: s for m in MODULES for name, s in m.SQL.items()}

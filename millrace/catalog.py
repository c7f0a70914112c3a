"""All registered queries of the library and their SQL, on the driver's tables as stand-ins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import assets, curation, evaluation, geometry, identifiers, reporting, sampling, statistics, stored, tables, textual

_MODULES = (identifiers, geometry, curation, sampling, assets, statistics, tables, evaluation, textual, reporting, stored)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for m in _MODULES for name, (run, _) in m.REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.REGISTRY.items() if sql}

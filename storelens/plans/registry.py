"""Registered queries: (spark, sf_dir) -> DataFrame, each with its DuckDB twin.

Every query reads the whole driver tables (through the bound views) so
its work grows with the data. Modules under ``storelens.plans`` add
entries with ``@query``; ``__spark_entry__`` exposes them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from storelens.session import ship_package
from storelens.sources.tables import Tables


@dataclass(frozen=True)
class Registered:
    name: str
    ops: str               # SURVEY §2 ids covered
    build: Callable[[Tables], DataFrame]
    sql: str | None        # DuckDB oracle, None = rows-only check


_REGISTRY: dict[str, Registered] = {}


def query(name: str, ops: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Registered(name, ops, fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Import for side effects (registration); order = presentation order.
    from storelens.plans import (q_retail, q_telemetry, q_retrieval,  # noqa: F401
                                 q_governance, q_streaming, q_sources)


def registry() -> dict[str, Registered]:
    _load_all()
    return dict(_REGISTRY)


def runner(r: Registered) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # the views and their oracles are defined in UTC (FIXTURES.md)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        ship_package(spark)
        return r.build(Tables(spark, sf_dir))
    run.__name__ = r.name
    run.__doc__ = f"{r.ops}: {r.build.__doc__ or ''}"
    return run

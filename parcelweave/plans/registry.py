"""Named queries over the test tables, each with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelweave.plans.samples import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load() -> None:
    """Import all workload modules."""
    import importlib
    import pkgutil

    from parcelweave.plans import workloads

    for m in pkgutil.iter_modules(workloads.__path__):
        importlib.import_module(f"{workloads.__name__}.{m.name}")

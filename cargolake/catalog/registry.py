"""Name -> (Spark query, SQL text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolake.catalog.views import Views, plain

REGISTRY: dict[str, tuple[Callable[[Views], DataFrame], str]] = {}


def query(sql: str) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    """Register a function under its name together with the SQL it must agree with."""

    def add(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return add


def runnable(fn: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(Views(spark, sf_dir)))

    run.__name__ = fn.__name__
    return run

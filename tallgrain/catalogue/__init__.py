"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL twin."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (  # noqa: F401
        cleaning,
        columns,
        encoding,
        learning,
        pipelines,
        quality,
        relating,
        sources,
        statistics,
        summaries,
    )

"""The bank job from end to end: raw files to staged tables to one table of clients."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources.tables import swap_table
from .customer360 import Sources, customer360
from .staging import Source, Staged, stage_all

#: The sources that the job needs, by name.
NAMES = ("loans", "demographics", "behaviour", "products")


@dataclass
class Done:
    staged: dict[str, Staged]
    table: str


def run_bank_job(
    spark: SparkSession,
    sources: Mapping[str, Source],
    out: str,
    database: str = "bank",
    table: str = "customer360",
    sample: int | None = None,
    seed: int = 0,
) -> Done:
    """Stage the four sources, merge the staged tables and swap the result in under its name.

    Each step reads what the one before has written, by table name, so a run that ends half-way
    is repeated from its start without harm, and readers see the older result until the new one
    is whole.
    """
    if missing := [n for n in NAMES if n not in sources]:
        raise ValueError(f"sources {missing} are missing")
    staged = stage_all(spark, sources, out, database)
    tables = Sources(*[spark.table(staged[n].table) for n in NAMES])
    return Done(staged, swap_table(customer360(tables, sample, seed), database, table, out))

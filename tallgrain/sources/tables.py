"""Catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import empty


def ensure_database(
    spark: SparkSession, name: str, location: str | None = None, select: bool = False
) -> None:
    """Create the database if it is missing; make it the current one if asked to."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    if select:
        spark.catalog.setCurrentDatabase(name)


def write_table(
    df: DataFrame, database: str, table: str, path: str, partition_by: list[str] | None = None
) -> str:
    """Write an external Parquet table, replacing an older one of that name."""
    name = f"{database}.{table}"
    writer = df.write.format("parquet").option("path", path).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def swap_table(df: DataFrame, database: str, table: str, root: str) -> str:
    """Write ``df`` into a new folder below ``root`` and let the table's name point to it.

    The folder of the version before stays, so queries that read it end well, and a write that
    fails leaves the table as it was.  ``df`` may read the very table that is replaced.
    """
    name, path = f"{database}.{table}", f"{root}/{table}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE `{database}`.`{table}` SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        # other columns: an external table leaves its files when it is dropped
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
        spark.catalog.createTable(name, path, "parquet")
    return name


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
    """The table, or no rows with its schema if it does not exist yet."""
    return spark.table(name) if spark.catalog.tableExists(name) else empty(spark, schema)

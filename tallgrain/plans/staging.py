"""Staging: raw files of the four sources into Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources.files import empty, path_exists, read_csv, read_json, split_corrupt
from ..sources.tables import ensure_database, write_table

# fixed values: the fields of the digital-behaviour source
BEHAVIOUR_SCHEMA = """cliente_id string, email string, dispositivos_activos int,
    frecuencia_login_mensual int, preferencia_canal string, ultima_actividad string,
    servicios_contratados array<string>"""


@dataclass
class Source:
    path: str
    kind: str  # "csv" or "json"
    schema: str | None = None


@dataclass
class Staged:
    table: str
    n_rows: int
    n_corrupt: int


def stage_all(
    spark: SparkSession, sources: Mapping[str, Source], out: str, database: str = "staged"
) -> dict[str, Staged]:
    """Read every source, set unreadable lines aside and write one table each.

    Each source is read once: the counts are taken while the table is written.  A source
    that is missing gives an empty table if its schema is known.
    """
    ensure_database(spark, database, f"{out}/{database}.db")
    done = {}
    for name, src in sources.items():
        if path_exists(spark, src.path):
            raw = (read_json if src.kind == "json" else read_csv)(spark, src.path, src.schema)
        elif src.schema is None:
            raise FileNotFoundError(f"source {name!r}: nothing at {src.path}")
        else:
            raw = empty(spark, src.schema)
        good, watch = split_corrupt(raw, name)
        table = write_table(good, database, f"table_{name}", f"{out}/{name}")
        seen = watch.get
        done[name] = Staged(table, seen["n_rows"], seen["n_corrupt"])
    return done

"""CSV and JSON in and out.  Nothing is inferred from the rows unless asked for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with the column that receives unreadable lines; all fields nullable."""
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != CORRUPT]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    dates: Mapping[str, str] | None = None,
    dtypes: Mapping[str, str] | None = None,
    skip_rows: int = 0,
) -> DataFrame:
    """CSV with a header.  Without a schema every column is text.

    ``dates`` maps columns to date patterns, ``dtypes`` columns to types; text that does not
    fit becomes null.  Lines that do not fit the table are kept in ``_corrupt_record``.
    ``skip_rows`` lines of title come before the header.
    """
    if skip_rows:
        df = _read_titled(spark, path, schema, sep, skip_rows)
    else:
        plain = spark.read.option("header", True).option("sep", sep)
        known = _struct(schema) if schema is not None else plain.csv(path).schema
        df = (
            plain.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .schema(_with_corrupt(known))
            .csv(path)
        )
    typed = {c: parse_date(c, fmt) for c, fmt in (dates or {}).items()}
    typed.update({c: F.col(c).try_cast(t) for c, t in (dtypes or {}).items()})
    return df.withColumns(typed) if typed else df


def _read_titled(spark, path, schema, sep, skip_rows) -> DataFrame:
    """The first ``skip_rows + 1`` lines of every file are left out; equal lines further on are data.

    Line numbers grow inside a partition, so in a file's first block its top lines have the smallest.
    The names come from the first file's header.
    """
    lines = spark.read.text(path)
    top = [r["value"] for r in lines.take(skip_rows + 1)]
    if len(top) <= skip_rows:
        raise ValueError(f"{path} has no header after {skip_rows} title lines")
    if schema is None:
        names = [n.strip().strip('"') for n in top[-1].split(sep)]
        known = T.StructType([T.StructField(n, T.StringType()) for n in names])
    else:
        known = _struct(schema)
    full = _with_corrupt(known)
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.file_block_start") == 0).alias("_head"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = placed.groupBy("_file").agg(F.min(F.when(F.col("_head"), F.col("_line"))).alias("_first"))
    is_top = F.col("_head") & (F.col("_line") <= F.col("_first") + skip_rows)
    body = placed.join(first, "_file").filter(~is_top & (F.trim("value") != ""))
    return body.select(F.from_csv("value", ddl, options).alias("_r")).select("_r.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; unreadable ones are kept in ``_corrupt_record``.

    Giving the schema saves a whole pass over the data.
    """
    known = _struct(schema) if schema is not None else spark.read.json(path).schema
    return (
        spark.read.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(_with_corrupt(known))
        .json(path)
    )


def split_corrupt(df: DataFrame, name: str = "read") -> tuple[DataFrame, Observation]:
    """Good rows, and the counts of all and corrupt rows.

    The counts are gathered while the good rows are used for the first time, so there is no
    extra job and nothing has to be cached.
    """
    if CORRUPT not in df.columns:
        watch = Observation(name)
        return df.observe(watch, F.count(F.lit(1)).alias("n_rows"), F.lit(0).alias("n_corrupt")), watch
    watch = Observation(name)
    seen = df.observe(
        watch,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"),
    )
    return seen.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), watch


def corrupt_rows(df: DataFrame) -> DataFrame:
    """The unreadable lines.  To count them, use the counts of ``split_corrupt``: Spark
    refuses a query on raw files that needs the corrupt column alone.
    """
    return df.filter(F.col(CORRUPT).isNotNull())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path or pattern matches anything, on whichever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(place)
    return found is not None and len(found) > 0


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_result(df: DataFrame, base: str, mode: str = "error") -> None:
    """The same rows as CSV (with header) and as JSON lines, worked out once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept.write.mode(mode).option("header", True).csv(f"{base}_csv")
        kept.write.mode(mode).json(f"{base}_json")
    finally:
        kept.unpersist()

"""Loading only files that have not been loaded before."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener


class RowLedger(StreamingQueryListener):
    """Input rows of every batch, by run and batch id; each report reaches it, however many there are.

    The end of a run is told after all its batches, so a ledger that has seen it is complete.
    """

    def __init__(self) -> None:
        self.rows: dict[str, dict[int, int]] = defaultdict(dict)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows[str(event.progress.runId)][event.progress.batchId] = event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def total(self, run_id: str) -> int:
        """Rows of a run that has been awaited."""
        self.ended[run_id].wait()
        return sum(self.rows[run_id].values())


def ingest_new(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | None = None,
    max_files: int | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Append the rows of new files under ``source`` to ``target``, each exactly once.

    The checkpoint remembers the files; a run that fails or is repeated neither loses nor
    doubles a row.  All files present are worked off, then the query ends.  Returns the
    number of input rows of this run.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(source)
    if prepare is not None:
        rows = prepare(rows)
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    ledger = RowLedger()
    spark.streams.addListener(ledger)
    try:
        run = writer.start(target)
        run.awaitTermination()
        return ledger.total(str(run.runId))
    finally:
        spark.streams.removeListener(ledger)


def ingest_counts(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    keys: list[str],
    fmt: str = "parquet",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
) -> None:
    """Count the rows of new files per key, without keeping or re-reading the rows.

    Every batch writes its counts into a folder of its own and replaces that folder if it is
    run again, so a batch that failed half-way is never counted twice.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(source)
    if prepare is not None:
        rows = prepare(rows)

    def write(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{target}/batch={number}")

    run = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def read_counts(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """Counts per key over all batches so far."""
    return spark.read.parquet(target).groupBy(*keys).agg(F.sum("n").alias("n"))

"""Incremental upsert as a Structured Streaming job.

Landed files are a file-source stream. Every micro-batch becomes a folder of
typed rows beside the checkpoint; when all that has landed is through, the
folders are merged into the Parquet store with the same newest-wins upsert as
the batch job. The months that a run touches are so rewritten once, not once per
micro-batch, whose number grows with the files. The sink is ``foreachBatch``,
which is at-least-once: a replayed micro-batch replaces its folder. Folders that
a stopped run has left are merged by the next; because rows are ranked by stored
columns (run, request order, position) and never by arrival, merging them again
changes nothing. With ``trigger(availableNow=True)`` the job processes what has
landed and stops, which is the re-run of the collection job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barsmith.sources.store import path_exists, remove_path, upsert_store


def run_upsert_stream(spark: SparkSession, landing: str, landing_schema: StructType,
                      to_rows: Callable[[DataFrame], DataFrame], store: str,
                      store_schema: StructType, keys: list[str], order: list[str],
                      sort_cols: list[str], checkpoint: str, fmt: str = "json",
                      max_files_per_trigger: int | None = None) -> None:
    """Process every landed file once (availableNow) into the store."""
    reader = spark.readStream.schema(landing_schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)

    pending = f"{checkpoint.rstrip('/')}-pending"

    def stage(batch: DataFrame, epoch: int) -> None:
        rows = to_rows(batch)
        rows.select(*[F.col(f.name).cast(f.dataType) for f in store_schema.fields]) \
            .write.mode("overwrite").parquet(f"{pending}/batch={epoch}")

    q = (stream.writeStream.foreachBatch(stage)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if path_exists(spark, pending) is not False:
        rows = spark.read.schema(store_schema).parquet(pending)
        upsert_store(spark, store, rows, store_schema, keys, order, sort_cols, stage=False)
        remove_path(spark, pending)

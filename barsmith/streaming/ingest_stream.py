"""Streaming form of the ingest jobs.

Landed response files are a file-source stream; each micro-batch runs the
same triage -> explode -> enrich -> upsert as the batch job. The store upsert
is idempotent, so a replayed micro-batch (``foreachBatch`` is at-least-once)
leaves the store unchanged, and one that the store's log lists is not written
again; report rows carry the micro-batch id so a replay can be recognised. A
micro-batch writes its own rows only, a segment per day (``sources.commit_log``).
``trigger(availableNow=True)`` processes what has landed and stops; a
processing-time trigger keeps it running.

The reports of a micro-batch say what became of its answers, and ``batch_metrics``
what it counted: rows read from its answers, written, and left out for their
timestamps, as observed while it ran (A5). What is open across
micro-batches -- requests without an answer in time, re-requests that a later
answer settles -- is followed per request where ``timeout`` is given
(``streaming.request_state``): the events go to ``<reports>/request_events``, and
``request_state.open_requests`` reads the re-request list from them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.plans import jobs as J
from barsmith.schemas import response_schema
from barsmith.sources.responses import with_landing
from barsmith.streaming.request_state import track_requests


#: Counts of a micro-batch in the ``batch_metrics`` report.
METRICS = ["rows_in", "rows_written", "bad_ts_rows", "n_partitions"]


def batch_metrics(spark: SparkSession, reports_path: str) -> DataFrame:
    """What each micro-batch of an ingest stream counted (A5). A micro-batch
    that was run again is one row, that of the run which committed it."""
    return spark.read.parquet(f"{reports_path}/batch_metrics").groupBy("batch_id") \
        .agg(*[F.max(c).alias(c) for c in METRICS], F.count(F.lit(1)).alias("n_runs"))


def stream_ingest(spark: SparkSession, kind: str, manifest: DataFrame, landing: str,
                  store_path: str, checkpoint: str, reports_path: str,
                  max_files_per_trigger: int | None = None,
                  available_now: bool = True,
                  granularity: str = J.DEFAULT_GRANULARITY, timeout: dt.timedelta | None = None,
                  asked_at: dt.datetime | None = None, cells: str = "text") -> None:
    schema = response_schema(kind, cells)

    def landed() -> DataFrame:
        reader = (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", "_corrupt_record"))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return with_landing(reader.json(landing))

    stream = landed()
    if timeout is not None and not available_now:
        _track(spark, kind, manifest, landed(), checkpoint, reports_path, asked_at, timeout, False)

    def each(batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        if kind == "options":
            res = J.ingest_options(s, manifest, batch, store_path, report_missing=False,
                                   granularity=granularity, stream=checkpoint, epoch=epoch)
        else:
            res = J.ingest_candles(s, kind, manifest, batch, store_path, report_missing=False,
                                   granularity=granularity, stream=checkpoint, epoch=epoch)
        tag = F.lit(epoch).cast("bigint").alias("batch_id")
        for name in ("quarantine", "rerequest", "summary", "run_summary", "split_manifest"):
            getattr(res, name).select("*", tag).write.mode("append").parquet(f"{reports_path}/{name}")
        # A replay that the store skips counts no rows; its row says so by the zeros.
        counts = [int(res.metrics.get(c) or 0) for c in METRICS]
        s.range(1).select(tag, *[F.lit(n).cast("bigint").alias(c) for c, n in zip(METRICS, counts)]) \
            .write.mode("append").parquet(f"{reports_path}/batch_metrics")
        res.release(s)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if timeout is not None:
            _track(spark, kind, manifest, landed(), checkpoint, reports_path, asked_at, timeout, True)


def _track(spark: SparkSession, kind: str, manifest: DataFrame, answers: DataFrame, checkpoint: str,
           reports_path: str, asked_at: dt.datetime | None, timeout: dt.timedelta, available_now: bool) -> None:
    track_requests(spark, kind, manifest, answers, f"{checkpoint}-requests", f"{reports_path}/request_events",
                   asked_at or dt.datetime.now(dt.timezone.utc), timeout, available_now=available_now)

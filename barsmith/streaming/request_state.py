"""State of every request of a run while its answers stream in.

The manifest is the initial state of a ``transformWithState`` operator keyed by
``request_id``; the stream is that of the landed answers, each with its outcome.
A request is in one of these states, and each change is an event:

* no event yet: asked, and its time is not up;
* ``rerequest``: only unusable answers so far (``reason``: fail, corrupt, bad_ts);
* ``missing``: its time is up (an event-time timer) and nothing has landed;
* ``answered``: a usable answer or a known gap (ok, empty, no_data, split);
* ``withdrawn``: answered after it was in the re-request list;
* ``orphan``: an answer to no request of this run.

Time is that at which files landed: a timer fires once files ``delay`` past a
request's deadline have landed. Of the answers in one micro-batch a usable one
decides. State is one small value per request; answers are read one by one and
never kept. Events are written to a folder per micro-batch, which a repeated
micro-batch replaces.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barsmith.functions.triage import classify_response
from barsmith.plans import jobs as J
from barsmith.sources.store import path_exists

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Outcomes after which a request is not sent again.
SETTLED = ("ok", "empty", "no_data", "split")
EVENTS = T.StructType([
    T.StructField("request_id", T.StringType()), T.StructField("event", T.StringType()),
    T.StructField("reason", T.StringType()), T.StructField("n_answers", T.LongType()),
])
OPEN = ["rerequest", "missing"]


class RequestState(StatefulProcessor):
    """``asked`` (in the manifest), ``done``, ``reason`` (why it is in the
    re-request list, if it is) and ``n`` answers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("request", "asked boolean, done boolean, reason string, n bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((True, False, None, 0))
        self.handle.registerTimer(int(initialState["deadline"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        asked, done, reason, n = self.state.get() if self.state.exists() else (False, False, None, 0)
        good = bad = None
        for row in rows:
            n += 1
            if row["outcome"] in SETTLED:
                good = max(good or "", row["outcome"])
            else:
                bad = max(bad or "", row["outcome"])
        event = None
        if not asked:
            event = None if done else ("orphan", bad or good)
            done = True
        elif good and not done:
            event = ("withdrawn" if reason else "answered", good)
            done, reason = True, None
        elif bad and not done and reason != bad:
            event, reason = ("rerequest", bad), bad
        self.state.update((asked, done, reason, n))
        if event:
            yield Row(request_id=key[0], event=event[0], reason=event[1], n_answers=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        asked, done, reason, n = self.state.get()
        if not done and reason is None:
            self.state.update((asked, done, "missing", n))
            yield Row(request_id=key[0], event="missing", reason="missing", n_answers=n)

    def close(self) -> None:
        pass


def answer_outcomes(answers: DataFrame, manifest: DataFrame, kind: str) -> DataFrame:
    """``request_id``, ``outcome`` and ``_landed_at`` of every readable answer."""
    sizes, n_rows, n_bad = J.answer_sizes(kind, answers)
    own = ["request_id", "from_date", "to_date", *(["side"] if kind == "options" else [])]
    slim = answers.where(F.col("request_id").isNotNull()).select(
        "request_id", "status", "errorCode", "errorMessage", "_corrupt_record", "_landed_at",
        *[c.alias(n) for n, c in sizes.items()])
    joined = slim.join(manifest.select(*own, F.lit(True).alias("_asked")), "request_id", "left")
    days = F.datediff("to_date", "from_date")
    outcome = classify_response("status", "errorCode", "errorMessage", days, corrupt="_corrupt_record",
                                n_rows=F.coalesce(n_rows, F.lit(0)))
    outcome = F.when(F.col("_asked").isNull(), "orphan") \
        .when((outcome == "ok") & (F.coalesce(n_bad, F.lit(0)) > 0), "bad_ts").otherwise(outcome)
    return joined.select("request_id", outcome.alias("outcome"), "_landed_at")


def track_requests(spark: SparkSession, kind: str, manifest: DataFrame, answers: DataFrame, checkpoint: str,
                   events_path: str, asked_at: dt.datetime, timeout: dt.timedelta,
                   delay: dt.timedelta = dt.timedelta(0), available_now: bool = True):
    """Follow the requests of ``manifest`` through the streaming ``answers`` (landed
    lines with ``_landed_at``); returns the streaming query."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    due = int((asked_at + timeout).timestamp() * 1000)
    first = manifest.select("request_id", F.lit(due).cast("bigint").alias("deadline")).dropDuplicates(["request_id"])
    seconds = int(delay.total_seconds())
    events = answer_outcomes(answers, manifest, kind).withWatermark("_landed_at", f"{seconds} seconds") \
        .groupBy("request_id").transformWithState(
            RequestState(), EVENTS, "Update", "EventTime", initialState=first.groupBy("request_id"))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{events_path}/batch={epoch}")

    writer = events.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(keep)
    query = (writer.trigger(availableNow=True) if available_now
             else writer.trigger(processingTime="1 minute")).start()
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return query


def request_states(spark: SparkSession, events_path: str, manifest: DataFrame) -> DataFrame:
    """The manifest with ``state`` (the last event, ``waiting`` before any),
    ``reason`` and ``n_answers``: what is known of every request now."""
    if path_exists(spark, events_path) is False:
        last = spark.createDataFrame([], "request_id string, e struct<event:string,reason:string,n_answers:bigint>")
    else:
        events = spark.read.schema(T.StructType([*EVENTS.fields, T.StructField("batch", T.LongType())])) \
            .parquet(events_path)
        last = events.groupBy("request_id").agg(
            F.max_by(F.struct("event", "reason", "n_answers"), "batch").alias("e"))
    return manifest.join(last, "request_id", "left").select(
        *manifest.columns, F.coalesce("e.event", F.lit("waiting")).alias("state"), F.col("e.reason").alias("reason"),
        F.coalesce("e.n_answers", F.lit(0)).cast("bigint").alias("n_answers"))


def open_requests(spark: SparkSession, events_path: str, manifest: DataFrame) -> DataFrame:
    """The re-request list as it stands: unanswered in time or only unusable
    answers, without those that a later answer has settled."""
    return request_states(spark, events_path, manifest).where(F.col("state").isin(OPEN))

"""End-to-end jobs: plan requests, ingest landed responses.

These replace the original job's three fetch loops with two Spark jobs per
dataset, run as often as wanted:

1. ``plan_*_requests`` -- resolve security ids from the landed instrument
   master, read each entity's stored high watermark, and emit the request
   manifest from the resume day to ``as_of`` (one row per request, with
   ``request_id`` and ``request_seq``). A collector outside Spark sends the
   requests and lands one JSON line per response under a landing folder.
2. ``ingest_*`` -- join landed responses to the manifest, triage them,
   explode the candle arrays with the dataset's length policy, enrich
   options, and upsert into the partitioned store. Splittable failures come
   back as a split manifest for the next run; other failures go to the
   quarantine output (or fail the run, for spot, like the original).

Every entity runs in the same job, keyed by column (no loop per entity).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from barsmith import config as C
from barsmith import functions as X
from barsmith.operators.dedupe import keep_last
from barsmith.operators.enrich import cast_option_candles, enrich_options
from barsmith.operators.explode import cell_parsers, explode_candles, explode_option_side, select_side
from barsmith.operators.summary import COUNTS as SUMMARY_COUNTS
from barsmith.operators.resolve import missing_symbols, resolve_indices, resolve_symbols
from barsmith.operators.watermark import resume_plan
from barsmith.plans import manifest as M
from barsmith.schemas import CANDLE, CANDLE_KEYS, OPTION_CANDLE, OPTION_KEYS, ORDER_COLUMNS
from barsmith.sources.responses import outcome_table, rank_answers, \
    read_intraday_responses, read_option_responses
from barsmith.session import scratch_path
from barsmith.sources.commit_log import CommitStore
from barsmith.sources.store import PARTITION_COLUMNS, partition_value, remove_path

ORDER = ["ingest_run", "request_seq", "pos"]
DEFAULT_GRANULARITY = "day"


def candle_store(granularity: str = DEFAULT_GRANULARITY) -> T.StructType:
    """Stored CANDLE schema: consumer columns, ordering columns and the
    partition column (``trade_date`` for day, ``trade_month`` for month)."""
    part = [T.StructField(PARTITION_COLUMNS[granularity], T.StringType())]
    return T.StructType(list(CANDLE.fields) + ORDER_COLUMNS + part)


def option_store(granularity: str = DEFAULT_GRANULARITY) -> T.StructType:
    part = [T.StructField(PARTITION_COLUMNS[granularity], T.StringType())]
    return T.StructType(list(OPTION_CANDLE.fields) + ORDER_COLUMNS + part)


CANDLE_STORE = candle_store()
OPTION_STORE = option_store()


@dataclass
class IngestResult:
    months: list[str]           # partitions (days or months) rewritten
    summary: DataFrame          # outcome counts per entity, sorted by entity (O3)
    run_summary: DataFrame      # per entity: rows in / keys new / replaced / rows out, resume day (R6)
    split_manifest: DataFrame   # half-range requests for the next run (R3)
    quarantine: DataFrame       # failed, unreadable, orphan, bad-timestamp and superseded answers
    rerequest: DataFrame        # requests to send again: missing, failed, corrupt, bad_ts (R1)
    metrics: dict               # rows_in / rows_written / n_partitions / bad_ts_rows (A5)
    scratch: list[str] = field(default_factory=list)  # staged tables the reports read

    def release(self, spark: SparkSession) -> None:
        """Delete the staged tables, once the reports have been written."""
        for path in self.scratch:
            remove_path(spark, path)


def open_store(spark: SparkSession, path: str, schema: T.StructType) -> CommitStore:
    """The commit-logged store of candles or option candles at ``path``."""
    if "underlying" in schema.names:
        return CommitStore(spark, path, schema, OPTION_KEYS, ORDER, ["underlying", "ts"], "underlying")
    return CommitStore(spark, path, schema, CANDLE_KEYS, ORDER, ["symbol", "ts"], "symbol")


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a store as of its last commit."""
    return open_store(spark, path, schema).read()


def consumer_view(store: DataFrame) -> DataFrame:
    """The consumer columns of a store (ordering columns dropped)."""
    return store.drop("ingest_run", "request_seq", "pos")


def _request_id(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def _watermarks(spark: SparkSession, store_path: str, schema: T.StructType) -> DataFrame:
    return open_store(spark, store_path, schema).watermarks()


# ---------------------------------------------------------------- planning

def plan_spot_requests(spark: SparkSession, master: DataFrame, store_path: str,
                       as_of: _dt.date | None, ingest_run: int,
                       granularity: str = DEFAULT_GRANULARITY) -> DataFrame:
    """Spot manifest: NIFTY 50 and SENSEX resolved by the index rules,
    90-day windows from the stored resume day (default 2021-01-01)."""
    ids = resolve_indices(master, C.INDEX_MATCH_RULES)
    names = spark.createDataFrame([(n, s.upper()) for n, s in C.SPOT_INDICES],
                                  "name string, symbol string")
    ents = names.join(ids.select("name", "security_id"), "name")
    plan = resume_plan(ents, _watermarks(spark, store_path, candle_store(granularity)),
                       "symbol", C.SPOT_START_DATE, X.as_of_date(as_of))
    reqs = M.candle_requests(plan.where("needs_fetch"), "start_date", "end_date",
                             ["symbol", "security_id"])
    return _candle_manifest(reqs, "spot", C.INDEX_EXCHANGE_SEGMENT, C.INDEX_INSTRUMENT_TYPE,
                            ingest_run)


def plan_stock_requests(spark: SparkSession, master: DataFrame, store_path: str,
                        as_of: _dt.date | None, ingest_run: int,
                        symbols: list[str] | DataFrame | None = None,
                        granularity: str = DEFAULT_GRANULARITY) -> tuple[DataFrame, DataFrame]:
    """Stock manifest for the symbol list (90-day windows from the resume
    day, default 2023-01-01), plus the symbols that could not be resolved."""
    req = symbols if isinstance(symbols, DataFrame) else \
        spark.createDataFrame([(s,) for s in (symbols or C.STOCK_SYMBOLS)], "symbol string")
    ids = resolve_symbols(master, req).where(F.col("security_id").isNotNull())
    plan = resume_plan(ids.select("symbol", "security_id"),
                       _watermarks(spark, store_path, candle_store(granularity)),
                       "symbol", C.STOCKS_START_DATE, X.as_of_date(as_of))
    reqs = M.candle_requests(plan.where("needs_fetch"), "start_date", "end_date",
                             ["symbol", "security_id"])
    return (_candle_manifest(reqs, "stocks", C.NSE_EQ, C.EQUITY, ingest_run),
            missing_symbols(master, req))


def _candle_manifest(reqs: DataFrame, kind: str, segment: str, instrument: str,
                     ingest_run: int) -> DataFrame:
    return reqs.select(
        _request_id(F.lit(kind), F.col("symbol"), F.col("from_date"), F.col("to_date"),
                    F.lit(ingest_run)).alias("request_id"),
        F.lit(ingest_run).cast("bigint").alias("ingest_run"), "request_seq",
        F.col("symbol"), "security_id", F.lit(segment).alias("segment"),
        F.lit(instrument).alias("instrument"), "window_idx", "from_date", "to_date",
        "from_text", "to_text")


def plan_option_requests(spark: SparkSession, master: DataFrame, store_path: str,
                         as_of: _dt.date | None, ingest_run: int,
                         granularity: str = DEFAULT_GRANULARITY) -> DataFrame:
    """Options manifest: each underlying's index id, 30-day windows from the
    stored resume day (default 2025-01-01) x 252 combos per window."""
    ids = resolve_indices(master, C.INDEX_MATCH_RULES)
    under = spark.createDataFrame(
        [(u, rule, seg, C.STRIKE_STEPS[u]) for u, rule, seg in C.OPTION_UNDERLYINGS],
        "underlying string, name string, segment string, strike_step int")
    ents = under.join(ids.select("name", "security_id"), "name")
    plan = resume_plan(ents, _watermarks(spark, store_path, option_store(granularity)),
                       "underlying", C.OPTIONS_START_DATE, X.as_of_date(as_of))
    reqs = M.option_requests(plan.where("needs_fetch"), "start_date", "end_date",
                             ["underlying", "security_id", "segment", "strike_step"])
    return reqs.select(
        _request_id(F.lit("options"), F.col("underlying"), F.col("from_date"),
                    F.col("expiry_type"), F.col("expiry_code"), F.col("bucket"), F.col("side"),
                    F.lit(ingest_run)).alias("request_id"),
        F.lit(ingest_run).cast("bigint").alias("ingest_run"), "request_seq", "underlying",
        "security_id", "segment", "strike_step", F.lit(C.OPTIDX).alias("instrument"),
        "window_idx", "from_date", "to_date", "from_text", "to_text",
        "expiry_type", "expiry_code", "bucket", "side")


def next_run_split_manifest(split_manifest: DataFrame, kind: str, ingest_run: int) -> DataFrame:
    """Turn the split manifest of one run into requests of the next run.
    Halves keep the top-level window; ``request_seq`` orders them by window,
    then start day, so the later half wins on the shared day (N4); option
    halves then go by their place in the 252 combos of a window.

    Halves of halves, which a later run fetches, rank in the run of the first
    halves (``split_run``): the pieces of a window are one order from left to
    right, whichever run fetched them."""
    seq = M.leaf_seq()
    run = F.lit(ingest_run).cast("bigint")
    rank = F.coalesce("split_run", run) if "split_run" in split_manifest.columns else run
    runs = [rank.alias("ingest_run"), rank.alias("split_run")]
    if kind == "options":
        own = [c for c in OPTION_SPLIT if c in split_manifest.columns and c not in ("request_seq", "split_run")]
        return split_manifest.select(
            _request_id(F.lit(kind), F.col("underlying"), F.col("from_date"), F.col("to_date"),
                        F.col("expiry_type"), F.col("expiry_code"), F.col("bucket"),
                        F.col("side"), run).alias("request_id"), *runs,
            (seq * M.COMBOS_PER_WINDOW + F.col("request_seq") % M.COMBOS_PER_WINDOW)
            .alias("request_seq"),
            *own, "window_idx", "from_date", "to_date", "from_text", "to_text")
    return split_manifest.select(
        _request_id(F.lit(kind), F.col("symbol"), F.col("from_date"), F.col("to_date"), run).alias("request_id"),
        *runs, seq.alias("request_seq"),
        "symbol", "security_id", "segment", "instrument", "window_idx", "from_date", "to_date",
        "from_text", "to_text")


# ---------------------------------------------------------------- ingest

OUTCOMES = ["ok", "bad_ts", "empty", "no_data", "split", "corrupt", "fail", "missing"]
OPTION_SPLIT = ["underlying", "security_id", "segment", "strike_step", "instrument", "expiry_type",
                "expiry_code", "bucket", "side", "request_seq", "split_run"]
CANDLE_SPLIT = ["symbol", "security_id", "segment", "instrument", "split_run"]
#: Epoch seconds a candle can have (1970 to 2100); others are unreadable timestamps.
TS_RANGE = (0, 4102444800)


def _responses(spark: SparkSession, landing: str | DataFrame, reader, cells: str) -> DataFrame:
    return landing if isinstance(landing, DataFrame) else reader(spark, landing, cells)


def _staged(spark: SparkSession, df: DataFrame, name: str, scratch: list[str]) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _stage_answers(spark: SparkSession, responses: DataFrame, scratch: list[str]
                   ) -> tuple[DataFrame, DataFrame]:
    """All landed answers, ranked, and those besides the one that decides for
    its request. The landed JSON is parsed here, once; triage and ingest read
    the staged table."""
    ranked = _staged(spark, rank_answers(responses), "answers", scratch)
    return ranked, ranked.where("_rank > 1")


def _reports(outcomes: DataFrame, superseded: DataFrame, manifest: DataFrame, entity: str):
    """Summary (sorted by entity, O3), quarantine and re-request list. Every
    landed answer is stored (``ok``; ``bad_ts`` for its readable candles), a
    known gap (``empty``, ``no_data``), in the split manifest or in the
    quarantine, which holds failed, unreadable, orphan, superseded and
    bad-timestamp answers. Requests without a usable answer -- missing, failed,
    unreadable, bad timestamps -- are re-requested (R1)."""
    summary = (outcomes.where(F.col("outcome") != "orphan")
               .groupBy(entity).pivot("outcome", OUTCOMES).count().fillna(0).orderBy(entity))
    columns = ["request_id", entity, "status", "errorCode", "errorMessage", "_corrupt_record",
               "n_bad_ts", "outcome"]
    late = superseded.join(manifest.select("request_id", entity), "request_id", "left").select(
        "*", F.lit(0).cast("bigint").alias("n_bad_ts"), F.lit("superseded").alias("outcome"))
    quarantine = outcomes.where(F.col("outcome").isin("fail", "corrupt", "orphan", "bad_ts")) \
        .select(*columns).unionByName(late.select(*columns))
    rerequest = outcomes.where(F.col("outcome").isin("missing", "fail", "corrupt", "bad_ts")) \
        .select(*manifest.columns, "outcome")
    return summary, quarantine, rerequest


def _answered(responses: DataFrame, outcomes: DataFrame, keep: tuple[str, ...],
              carry: list[str]) -> DataFrame:
    """Usable bodies of the requests whose outcome is in ``keep``, with the
    request columns the rows carry (one equi-join on ``request_id``, which is
    unique in the outcomes). All usable answers of a request bring their
    candles; ``_fresh`` is larger for those that landed later."""
    req = outcomes.where(F.col("outcome").isin(*keep)).select("request_id", *carry)
    return responses.where("_usable").withColumn("_fresh", -F.col("_rank")).join(req, "request_id")


def _one_per_key(rows: DataFrame, superseded: DataFrame, keys: list[str]) -> DataFrame:
    """Where some request has several usable answers, the candle of the one
    that landed last wins a tie of run, request and position."""
    if superseded.where("_usable").limit(1).count():
        rows = keep_last(rows, keys, [*ORDER, "_fresh"])
    return rows.drop("_fresh")


def _with_resume_day(reports: dict, manifest: DataFrame, entity: str) -> DataFrame:
    """Per-entity run summary (R6) with the day the run resumed from (the
    first requested day). Entities whose requests brought no candles show
    zero counts."""
    first_day = manifest.groupBy(entity).agg(F.min("from_date").alias("resume_date"))
    counts = reports.get("entity_summary")
    if counts is None:  # nothing was written this run
        return first_day.select(entity, *[F.lit(0).cast("bigint").alias(c) for c in SUMMARY_COUNTS],
                                "resume_date")
    j = first_day.join(counts, entity, "full")
    return j.select(entity, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
                              for c in SUMMARY_COUNTS], "resume_date").orderBy(entity)


def _bad_ts(ts: Column) -> Column:
    """Whether an epoch second cannot be that of a candle."""
    return F.coalesce(~ts.between(*TS_RANGE), F.lit(True))


def _count_bad_ts(cells: Column, dtype: T.ArrayType) -> Column:
    """Timestamp cells of a response that cannot be read."""
    return F.size(F.filter(F.coalesce(cells, F.array().cast(dtype)),
                           lambda x: _bad_ts(cell_parsers(dtype).to_long(x))))


def _drop_bad_ts(rows: DataFrame):
    """Candles whose timestamp cell is no plausible time cannot be keyed; they
    are left out and counted (``bad_ts_rows``) while the batch is staged. Their
    answer is in the quarantine and its request in the re-request list."""
    obs = Observation("bad_ts_rows")
    rows = rows.observe(obs, F.count(F.when(_bad_ts(F.col("ts")), 1)).alias("bad_ts_rows"))
    return rows.where(~_bad_ts(F.col("ts"))), obs


def _split_manifest(outcomes: DataFrame, keep: list[str], option_text: bool = False) -> DataFrame:
    """Half-range requests for the answers that ask for a shorter range."""
    failed = outcomes.where(F.col("outcome") == "split")
    if "window_idx" not in failed.columns:
        failed = failed.withColumn("window_idx", F.lit(1))
    own = [c for c in keep if c in failed.columns]
    return M.split_requests(failed.select(*own, "window_idx", "from_date", "to_date"), own, option_text)


def answer_sizes(kind: str, responses: DataFrame) -> tuple[dict[str, Column], Column, Column]:
    """Per landed answer, the sizes computed before it meets its request; and,
    after, its number of timestamps and of unreadable ones (an option answer's
    depend on the side that was asked for)."""
    dtype = (responses.select("data.ce.timestamp") if kind == "options" else responses).schema["timestamp"].dataType
    empty = F.array().cast(dtype)
    if kind != "options":
        n = F.size(F.coalesce(F.col("timestamp"), empty))
        return {"_n": n, "_bad": _count_bad_ts(F.col("timestamp"), dtype)}, F.col("_n"), F.col("_bad")
    sizes = {f"_{name}_{s}": size(F.col(f"data.{s}.timestamp"))
             for name, size in (("n", lambda c: F.size(F.coalesce(c, empty))),
                                ("bad", lambda c: _count_bad_ts(c, dtype)))
             for s in ("ce", "pe")}
    by_side = lambda c: F.when(F.col("side") == "CALL", F.col(f"_{c}_ce")).otherwise(F.col(f"_{c}_pe"))
    return sizes, by_side("n"), by_side("bad")


def ingest_candles(spark: SparkSession, kind: str, manifest: DataFrame,
                   landing: str | DataFrame, store_path: str,
                   report_missing: bool = True,
                   granularity: str = DEFAULT_GRANULARITY,
                   strict_cells: bool = False, stream: str | None = None,
                   epoch: int | None = None, cells: str = "text") -> IngestResult:
    """Spot (strict arrays, failures abort) or stocks (zero fill, failures
    skipped) responses -> CANDLE store. ``landing`` is the landing folder or
    an already-read response frame (a stream micro-batch). ``strict_cells``
    fails on a null or unreadable cell inside an array (N5). ``cells="variant"``
    reads the landing folder with cells that keep their JSON type. A micro-batch
    (``epoch`` of ``stream``) that the store has committed is not written again."""
    if kind not in ("spot", "stocks"):
        raise ValueError(kind)
    scratch: list[str] = []
    responses, superseded = _stage_answers(
        spark, _responses(spark, landing, read_intraday_responses, cells), scratch)
    sizes, n_rows, n_bad = answer_sizes(kind, responses)
    outcomes = _staged(spark, outcome_table(responses.where("_rank = 1"), manifest, sizes, n_rows,
                                            report_missing, n_bad), "outcomes", scratch)
    if kind == "spot":
        # Spot: any non-splittable failure aborts the run before anything is
        # saved, an unreadable line or timestamp included (the bounded check
        # reads one row of the slim table).
        unreadable = (F.col("outcome") == "orphan") & F.col("_corrupt_record").isNotNull()
        failed = outcomes.where(F.col("outcome").isin("fail", "corrupt", "bad_ts") | unreadable) \
            .limit(1).collect()
        if failed:
            raise RuntimeError(f"request failed: {failed[0]['request_id'] or 'unreadable response'}")
    summary, quarantine, rerequest = _reports(outcomes, superseded, manifest, "symbol")
    ok = _answered(responses, outcomes, ("ok", "bad_ts"), ["symbol", "ingest_run", "request_seq"])
    rows = explode_candles(ok, "strict" if kind == "spot" else "zero_fill",
                           carry=["symbol", "ingest_run", "request_seq", "_fresh"],
                           strict_cells=strict_cells, label=F.col("request_id"))
    rows, bad_ts = _drop_bad_ts(rows)
    rows = _one_per_key(rows, superseded, CANDLE_KEYS)
    rows = (rows.withColumn("datetime", X.epoch_to_ist_iso("ts"))
            .withColumn(PARTITION_COLUMNS[granularity], partition_value("ts", granularity)))
    metrics: dict = {}
    reports: dict = {}
    months = open_store(spark, store_path, candle_store(granularity)).upsert(
        rows, stream, epoch, metrics=metrics, reports=reports)
    metrics.update(bad_ts.get if months else {"bad_ts_rows": 0})
    return IngestResult(months=months, summary=summary,
                        split_manifest=_split_manifest(outcomes, CANDLE_SPLIT),
                        quarantine=quarantine, rerequest=rerequest, metrics=metrics,
                        run_summary=_with_resume_day(reports, manifest, "symbol"),
                        scratch=scratch + reports.get("scratch", []))


def ingest_options(spark: SparkSession, manifest: DataFrame, landing: str | DataFrame,
                   store_path: str, report_missing: bool = True,
                   granularity: str = DEFAULT_GRANULARITY,
                   strict_cells: bool = False, stream: str | None = None,
                   epoch: int | None = None, cells: str = "text") -> IngestResult:
    """Rolling-option responses -> enriched OPTION_CANDLE store. Failed
    combos are skipped (reported in the quarantine output and re-requested);
    combos whose range was too long come back halved in the split manifest.
    ``cells`` is as in ``ingest_candles``."""
    scratch: list[str] = []
    responses, superseded = _stage_answers(
        spark, _responses(spark, landing, read_option_responses, cells), scratch)
    sizes, n_rows, n_bad = answer_sizes("options", responses)
    outcomes = _staged(spark, outcome_table(responses.where("_rank = 1"), manifest, sizes, n_rows,
                                            report_missing, n_bad), "outcomes", scratch)
    summary, quarantine, rerequest = _reports(outcomes, superseded, manifest, "underlying")
    carry = ["ingest_run", "request_seq", "underlying", "side", "expiry_type", "expiry_code",
             "bucket", "strike_step"]
    kept = [*carry, "_fresh"]
    ok = _answered(responses, outcomes, ("ok", "bad_ts"), carry)
    sided = ok.select(*kept, select_side(F.col("data"), F.col("side")).alias("side_data"))
    rows = explode_option_side(sided, "side_data", carry=kept, strict_cells=strict_cells)
    rows, bad_ts = _drop_bad_ts(rows)
    rows = rows.withColumn(
        "option_type", F.when(F.col("side") == "CALL", F.lit("CE")).otherwise(F.lit("PE")))
    typed = cast_option_candles(enrich_options(rows), extra=[*ORDER, "_fresh"])
    typed = _one_per_key(typed, superseded, OPTION_KEYS) \
        .withColumn(PARTITION_COLUMNS[granularity], partition_value("ts", granularity))
    metrics: dict = {}
    reports: dict = {}
    months = open_store(spark, store_path, option_store(granularity)).upsert(
        typed, stream, epoch, metrics=metrics, reports=reports)
    metrics.update(bad_ts.get if months else {"bad_ts_rows": 0})
    return IngestResult(months=months, summary=summary,
                        split_manifest=_split_manifest(outcomes, OPTION_SPLIT, option_text=True),
                        quarantine=quarantine, rerequest=rerequest, metrics=metrics,
                        run_summary=_with_resume_day(reports, manifest, "underlying"),
                        scratch=scratch + reports.get("scratch", []))


def register_views(spark: SparkSession, spot: str | None = None, stocks: str | None = None,
                   options: str | None = None,
                   granularity: str = DEFAULT_GRANULARITY) -> list[str]:
    """Temp views over the stores for SQL users: ``spot_candles``,
    ``stock_candles``, ``option_candles`` (consumer columns plus the
    partition column for pruning). Returns the view names."""
    made = []
    for name, path, schema in (("spot_candles", spot, candle_store(granularity)),
                               ("stock_candles", stocks, candle_store(granularity)),
                               ("option_candles", options, option_store(granularity))):
        if path:
            consumer_view(read_store(spark, path, schema)).createOrReplaceTempView(name)
            made.append(name)
    return made

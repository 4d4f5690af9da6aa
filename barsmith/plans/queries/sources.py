"""Coverage, triage, landed sources and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from barsmith import functions as X
from barsmith.config import STRIKE_BUCKETS
from barsmith.operators.coverage import coverage_gaps as _gaps
from barsmith.operators.explode import explode_option_side, select_side
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import EV_CTE, IST_ISO, OPTION_ROWS_SQL, register
from barsmith.plans.queries.store import LINE_BATCHES_CTE, STORE_KEYS, STORE_ORDER, STORE_SCHEMA
from barsmith.session import scratch_path
from barsmith.sources.instruments import land_master
from barsmith.sources.legacy import read_legacy, to_legacy_layout
from barsmith.sources.responses import read_option_responses
from barsmith.sources.store import read_store, trade_month
from barsmith.streaming.upsert_stream import run_upsert_stream


@register("coverage_gaps", """
WITH o AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
s AS (SELECT user_id, min(day) AS s, max(day) AS e FROM o GROUP BY user_id),
p AS (SELECT user_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
g AS (SELECT user_id, day FROM p EXCEPT SELECT user_id, day FROM o)
SELECT user_id, day AS from_date, day + 1 AS to_date FROM g
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, every day from first to last observed day is planned;
    planned days with no observed candle are gaps, each emitted as a one-day
    re-request."""
    ev = V.event_bars(V.table(spark, sf_dir, "events"))
    observed = ev.select("user_id", "day")
    return _gaps(observed, "user_id", "day")


@register("triage", f"""
WITH {EV_CTE.strip()},
r AS (
  SELECT event_id,
    CASE event_type WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 400 ELSE 500 END
                    WHEN 'signup' THEN 404 ELSE 200 END AS status,
    CASE event_type WHEN 'signup' THEN CASE k % 3 WHEN 0 THEN 'DH-905' WHEN 1 THEN 'DH-907'
                                       ELSE 'DH-908' END
                    WHEN 'error' THEN 'DH-901' END AS error_code,
    CASE event_type WHEN 'signup' THEN CASE WHEN k < 50 THEN 'No Data present for the request'
                                            ELSE 'Invalid Request' END
                    WHEN 'error' THEN 'Bad request window' END AS msg,
    k % 4 AS days,
    CASE WHEN event_type = 'click' AND k < 10 THEN 0 ELSE 1 END AS n_rows
  FROM ev)
SELECT event_id, status, error_code,
  CASE WHEN error_code IN ('DH-905', 'DH-907') AND contains(lower(coalesce(msg, '')), 'no data')
         THEN 'no_data'
       WHEN coalesce(status, 200) BETWEEN 200 AND 299 AND error_code IS NULL
         THEN CASE WHEN n_rows = 0 THEN 'empty' ELSE 'ok' END
       WHEN status = 400 AND days > 1 THEN 'split'
       ELSE 'fail' END AS outcome
FROM r
""")
def triage_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a response envelope (status, error code,
    message, window days, body size) classified into ok / empty / no_data /
    split / fail."""
    ev = V.event_bars(V.table(spark, sf_dir, "events"))
    et, k = F.col("event_type"), F.col("k")
    status = (F.when(et == "error", F.when(k % 2 == 0, 400).otherwise(500))
              .when(et == "signup", 404).otherwise(200))
    code = (F.when(et == "signup", F.when(k % 3 == 0, "DH-905").when(k % 3 == 1, "DH-907")
                   .otherwise("DH-908"))
            .when(et == "error", "DH-901"))
    msg = (F.when(et == "signup", F.when(k < 50, "No Data present for the request")
                  .otherwise("Invalid Request"))
           .when(et == "error", "Bad request window"))
    n_rows = F.when((et == "click") & (k < 10), 0).otherwise(1)
    r = ev.select("event_id", status.alias("status"), code.alias("error_code"),
                  msg.alias("msg"), (k % 4).alias("days"), n_rows.alias("n_rows"))
    return r.select("event_id", "status", "error_code",
                    X.classify_response("status", "error_code", "msg", "days",
                                        n_rows="n_rows").alias("outcome"))


@register("option_response_scan", OPTION_ROWS_SQL + """
SELECT underlying, option_type, expiry_type, expiry_code, bucket_idx, request_seq, pos, ts,
       strike, spot, open, high, low, close, iv, volume, oi
FROM o WHERE ingest_run = 1
""")
def option_response_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option responses landed as JSON lines (request id + body
    only) and a manifest with the request attributes; the JSON is read with
    text cells, joined to its request and exploded with the null-fill policy."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1)
    rid = F.concat_ws("-", F.col("request_seq").cast("string"), F.col("user_id").cast("string"))
    root = scratch_path(spark, "option-landing")
    resp.select(rid.alias("request_id"), F.lit(200).alias("status"), "data") \
        .write.mode("overwrite").json(f"{root}/responses")
    resp.select(rid.alias("request_id"), "request_seq", "underlying", "side", "expiry_type",
                "expiry_code", "bucket").write.mode("overwrite").parquet(f"{root}/manifest")
    landed = read_option_responses(spark, f"{root}/responses")
    manifest = spark.read.parquet(f"{root}/manifest")
    sided = manifest.join(landed, "request_id").select(
        "request_seq", "underlying", "side", "expiry_type", "expiry_code", "bucket",
        select_side(F.col("data"), F.col("side")).alias("s"))
    rows = explode_option_side(sided, "s", carry=["request_seq", "underlying", "side",
                                                  "expiry_type", "expiry_code", "bucket"])
    idx = F.array_position(F.array(*[F.lit(b) for b in STRIKE_BUCKETS]), F.col("bucket")) - 1
    return rows.select(
        "underlying",
        F.when(F.col("side") == "CALL", F.lit("CE")).otherwise(F.lit("PE")).alias("option_type"),
        "expiry_type", "expiry_code", idx.cast("bigint").alias("bucket_idx"), "request_seq",
        F.col("pos").cast("bigint").alias("pos"), "ts", "strike", "spot", "open", "high", "low",
        "close", "iv", "volume", "oi")


@register("master_scan", """
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_seq,
       CAST(p_partkey AS VARCHAR) AS SEM_SMST_SECURITY_ID,
       CASE WHEN p_size = 1 THEN NULL ELSE p_brand END AS SYMBOL_NAME,
       p_name AS DISPLAY_NAME, p_type AS INSTRUMENT_TYPE,
       CAST(p_size AS VARCHAR) AS LOT_SIZE, p_retailprice AS price
FROM part
""")
def master_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table landed as a CSV master (padded header
    names, cells padded with spaces and tabs, several files in key order),
    read back as text, stripped, numbered in line order and landed as
    Parquet."""
    part = V.table(spark, sf_dir, "part")
    pad = F.col("p_size") % 2 == 0
    csv = part.select(
        F.col("p_partkey").cast("string").alias(" SEM_SMST_SECURITY_ID "),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_brand")).alias("SYMBOL_NAME"),
        F.when(pad, F.concat(F.lit("\t"), "p_name", F.lit(" "))).otherwise(F.col("p_name"))
        .alias("\tDISPLAY_NAME"),
        F.when(~pad, F.concat(F.lit("  "), "p_type")).otherwise(F.col("p_type"))
        .alias("INSTRUMENT_TYPE "),
        F.col("p_size").cast("string").alias("LOT_SIZE"),
        F.col("p_retailprice").cast("string").alias("PRICE"),
        "p_partkey")
    root = scratch_path(spark, "master")
    (csv.orderBy("p_partkey").drop("p_partkey").write.mode("overwrite")
     .option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(f"{root}/csv"))
    landed = land_master(spark, f"{root}/csv", f"{root}/landed")
    return landed.select("row_seq", "SEM_SMST_SECURITY_ID", "SYMBOL_NAME", "DISPLAY_NAME",
                         "INSTRUMENT_TYPE", "LOT_SIZE", X.to_double("PRICE").alias("price"))


LANDING_SCHEMA = T.StructType([
    T.StructField(f.name, f.dataType) for f in STORE_SCHEMA.fields if f.name != "trade_month"])


@register("stream_upsert", LINE_BATCHES_CTE + """
SELECT 'S' || l_suppkey AS symbol, ts, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_returnflag, ingest_run,
       strftime(make_timestamp(ts * 1000000) + INTERVAL 330 MINUTE, '%Y-%m') AS trade_month
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ts
        ORDER BY ingest_run DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM b)
WHERE rn = 1
""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both runs land as JSON files; an availableNow file stream merges
    them into the Parquet store one file per micro-batch; the store is read
    back. Equal to the batch upsert whatever the arrival order."""
    run1, run2 = V.lineitem_batches(V.table(spark, sf_dir, "lineitem"))
    root = scratch_path(spark, "stream")
    cols = LANDING_SCHEMA.names
    # Land the later run first: arrival order must not decide the winner.
    run2.select(*cols).write.mode("append").json(f"{root}/landing")
    run1.select(*cols).write.mode("append").json(f"{root}/landing")
    run_upsert_stream(
        spark, f"{root}/landing", LANDING_SCHEMA,
        lambda b: b.withColumn("trade_month", trade_month("ts")),
        f"{root}/store", STORE_SCHEMA, STORE_KEYS, STORE_ORDER, ["symbol", "ts"],
        checkpoint=f"{root}/checkpoint", max_files_per_trigger=4)
    return read_store(spark, f"{root}/store", STORE_SCHEMA)


@register("legacy_layout_scan", f"""
SELECT 'S' || l_suppkey AS symbol, epoch_us(l_shipdate) // 1000000 AS ts,
       {IST_ISO.format(x='epoch_us(l_shipdate) // 1000000')} AS datetime,
       l_extendedprice AS open, l_extendedprice AS high, l_extendedprice AS low,
       l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume
FROM lineitem
""")
def legacy_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles in the original layout, ``stocks/<SYMBOL>/<SYMBOL>_1m.parquet``,
    read back by the real globs in one scan; the symbol comes from
    ``_metadata.file_path``. Each entity's rows meet in one task, which writes its
    file (a large entity has several) under the layout's name."""
    li = V.table(spark, sf_dir, "lineitem")
    ts = X.epoch_seconds("l_shipdate")
    root = scratch_path(spark, "legacy")
    rows = li.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sym"),
                     ts.alias("ts"), X.epoch_to_ist_iso(ts).alias("datetime"),
                     *[F.col("l_extendedprice").alias(c) for c in ("open", "high", "low", "close")],
                     F.col("l_quantity").cast("bigint").alias("volume"))
    to_legacy_layout(spark, rows, "sym", f"{root}/stocks")
    return read_legacy(spark, root, "stocks")

"""The end-to-end ingest jobs on landed responses derived from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.plans import driver_views as V
from barsmith.plans import jobs as J
from barsmith.plans.queries.common import (
    CANDLE_ROWS_CTE,
    IST_ISO,
    OPTION_ROWS_SQL,
    register,
    strike_step,
)
from barsmith.session import scratch_path


def written(df: DataFrame, path: str) -> DataFrame:
    """A manifest as a collector would find it: written once, then read."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("ingest_stocks_job", CANDLE_ROWS_CTE + f"""
SELECT 'U' || user_id AS symbol, sec AS ts, {IST_ISO.format(x='sec')} AS datetime,
  CASE WHEN pos < n - user_id % 3 THEN value ELSE CAST(0 AS DOUBLE) END AS open,
  value + CAST(1 AS DOUBLE) AS high, value - CAST(1 AS DOUBLE) AS low,
  CASE WHEN pos < n - user_id % 2 THEN value + CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    AS close,
  CASE WHEN pos < n - user_id % 3 THEN k ELSE 0 END AS volume
FROM r
""")
def ingest_stocks_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock ingest job end to end: responses land as JSON lines keyed by
    request id, the manifest carries symbol and window, ``jobs.ingest_candles``
    triages, explodes (zero fill), upserts into a fresh store, which is read
    back through the consumer view."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    rid = F.concat_ws("-", F.col("symbol"), F.col("win").cast("string"))
    root = scratch_path(spark, "stocks-job")
    resp.select(rid.alias("request_id"), F.lit(200).alias("status"), "timestamp",
                F.col("open_short").alias("open"), "high", "low",
                F.col("close_short").alias("close"), F.col("volume_short").alias("volume")) \
        .write.mode("overwrite").json(f"{root}/landing")
    manifest = resp.select(
        rid.alias("request_id"), F.lit(1).cast("bigint").alias("ingest_run"),
        F.col("win").alias("request_seq"),
        "symbol", F.col("user_id").cast("string").alias("security_id"),
        F.lit("NSE_EQ").alias("segment"), F.lit("EQUITY").alias("instrument"),
        (F.col("win") + 1).cast("int").alias("window_idx"),
        V.window_start(F.col("win")).alias("from_date"),
        V.window_start(F.col("win") + 1).alias("to_date"))
    manifest = written(manifest, f"{root}/manifest")
    J.ingest_candles(spark, "stocks", manifest, f"{root}/landing", f"{root}/store")
    return J.consumer_view(J.read_store(spark, f"{root}/store", J.CANDLE_STORE)) \
        .drop("trade_date")


@register("ingest_options_job", OPTION_ROWS_SQL + """
SELECT ts, datetime, underlying, option_type, expiry_type, expiry_code, atm_strike,
       strike_offset, moneyness, strike, spot, open, high, low, close, volume, oi, iv
FROM (SELECT *, row_number() OVER (
        PARTITION BY ts, underlying, option_type, expiry_type, expiry_code, strike
        ORDER BY request_seq DESC, pos DESC) AS rn FROM o WHERE ingest_run = 1)
WHERE rn = 1
""")
def ingest_options_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The options ingest job end to end: rolling-option bodies land as JSON
    keyed by request id; the manifest carries the request attributes and the
    strike step; ``jobs.ingest_options`` triages, picks the side, explodes,
    enriches and upserts into a fresh store, read back as OPTION_CANDLE."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1)
    rid = F.concat_ws("-", F.col("request_seq").cast("string"), F.col("user_id").cast("string"))
    root = scratch_path(spark, "options-job")
    resp.select(rid.alias("request_id"), F.lit(200).alias("status"), "data") \
        .write.mode("overwrite").json(f"{root}/landing")
    manifest = resp.select(
        rid.alias("request_id"), "ingest_run", "request_seq", "underlying", "side",
        "expiry_type", "expiry_code", "bucket", strike_step(F.col("underlying"))
        .alias("strike_step"), V.window_start(F.col("win")).alias("from_date"),
        V.window_start(F.col("win") + 1).alias("to_date"))
    manifest = written(manifest, f"{root}/manifest")
    J.ingest_options(spark, manifest, f"{root}/landing", f"{root}/store")
    return J.consumer_view(J.read_store(spark, f"{root}/store", J.OPTION_STORE)) \
        .drop("trade_date")

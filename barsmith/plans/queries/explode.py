"""Response explode policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import functions as X
from barsmith.config import STRIKE_BUCKETS
from barsmith.operators.cast import cast_to_schema
from barsmith.operators.explode import explode_candles, explode_option_side, select_side
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import CANDLE_ROWS_CTE, IST_ISO, OPTION_ROWS_SQL, register
from barsmith.schemas import CANDLE


def _candles(resp: DataFrame, policy: str, open_c: str, close_c: str, vol_c: str) -> DataFrame:
    shaped = resp.select("symbol", "timestamp", F.col(open_c).alias("open"), "high", "low",
                         F.col(close_c).alias("close"), F.col(vol_c).alias("volume"))
    rows = explode_candles(shaped, policy, carry=["symbol"], label=F.col("symbol"))
    return cast_to_schema(rows.withColumn("datetime", X.epoch_to_ist_iso("ts")), CANDLE)


@register("explode_strict", CANDLE_ROWS_CTE + f"""
SELECT 'U' || user_id AS symbol, sec AS ts, {IST_ISO.format(x='sec')} AS datetime,
  value AS open, value + CAST(1 AS DOUBLE) AS high, value - CAST(1 AS DOUBLE) AS low,
  value + CAST(0.5 AS DOUBLE) AS close,
  CASE WHEN pos < n - user_id % 3 THEN k ELSE 0 END AS volume
FROM r
""")
def explode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spot policy. Aligned price arrays (a misaligned one fails
    the job); short volume arrays padded with 0."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    return _candles(resp, "strict", "open_full", "close_full", "volume_short")


@register("explode_zero_fill", CANDLE_ROWS_CTE + f"""
SELECT 'U' || user_id AS symbol, sec AS ts, {IST_ISO.format(x='sec')} AS datetime,
  CASE WHEN pos < n - user_id % 3 THEN value ELSE CAST(0 AS DOUBLE) END AS open,
  value + CAST(1 AS DOUBLE) AS high, value - CAST(1 AS DOUBLE) AS low,
  CASE WHEN pos < n - user_id % 2 THEN value + CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    AS close,
  CASE WHEN pos < n - user_id % 3 THEN k ELSE 0 END AS volume
FROM r
""")
def explode_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock policy. Short open/close arrays give 0.0 past their end,
    short volume gives 0."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    return _candles(resp, "zero_fill", "open_short", "close_short", "volume_short")


@register("explode_null_fill", OPTION_ROWS_SQL + """
SELECT underlying, option_type, expiry_type, expiry_code, bucket_idx, request_seq, pos, ts,
       strike, spot, open, high, low, close, iv, volume, oi
FROM o WHERE ingest_run = 1
  AND user_id % 7 <> 0  -- F5: their arrays sit under the other side, which gives no rows
""")
def explode_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option policy on one run of option responses. The side is
    picked from ``data.ce``/``data.pe`` by the request (missing side: no
    rows); short prices/iv are null, missing oi is 0; strike and spot accept
    ``""``; request attributes are carried onto every row."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1, misplaced=True)
    sided = resp.select("request_seq", "underlying", "side", "expiry_type", "expiry_code",
                        "bucket", select_side(F.col("data"), F.col("side")).alias("s"))
    rows = explode_option_side(sided, "s", carry=["request_seq", "underlying", "side",
                                                  "expiry_type", "expiry_code", "bucket"])
    idx = F.array_position(F.array(*[F.lit(b) for b in STRIKE_BUCKETS]), F.col("bucket")) - 1
    return rows.select(
        "underlying",
        F.when(F.col("side") == "CALL", F.lit("CE")).otherwise(F.lit("PE")).alias("option_type"),
        "expiry_type", "expiry_code", idx.cast("bigint").alias("bucket_idx"), "request_seq",
        F.col("pos").cast("bigint").alias("pos"), "ts", "strike", "spot", "open", "high", "low",
        "close", "iv", "volume", "oi")

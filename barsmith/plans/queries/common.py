"""Registry of the driver queries and what they share: the decorator,
option helpers and the DuckDB oracle fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.config import STRIKE_STEPS
from barsmith.operators.enrich import cast_option_candles, enrich_options
from barsmith.operators.explode import explode_option_side, select_side


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RUN_ORDER = ["ingest_run", "request_seq", "pos"]


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def strike_step(underlying) -> F.Column:
    """Underlying -> strike step (J6) as a literal map lookup; an unknown
    underlying fails the job, as a missing config key does in the original."""
    m = F.create_map(*[x for k, v in STRIKE_STEPS.items() for x in (F.lit(k), F.lit(v))])
    step = F.element_at(m, underlying)
    return F.when(step.isNull(), F.raise_error(F.concat(
        F.lit("no strike step for "), underlying))).otherwise(step)


def option_candles(responses: DataFrame) -> DataFrame:
    """Landed option responses -> typed OPTION_CANDLE rows (before dedupe),
    keeping the ordering columns."""
    sided = responses.select(
        "ingest_run", "request_seq", "underlying", "side", "expiry_type", "expiry_code",
        "bucket", select_side(F.col("data"), F.col("side")).alias("side_data"))
    rows = explode_option_side(
        sided, "side_data",
        carry=["ingest_run", "request_seq", "underlying", "side", "expiry_type",
               "expiry_code", "bucket"])
    rows = (rows
            .withColumn("option_type",
                        F.when(F.col("side") == "CALL", F.lit("CE")).otherwise(F.lit("PE")))
            .withColumn("strike_step", strike_step(F.col("underlying"))))
    return cast_option_candles(enrich_options(rows), extra=RUN_ORDER)


# --------------------------------------------------------------------------
# Shared oracle fragments (DuckDB). ``ev`` mirrors driver_views.event_bars.
# --------------------------------------------------------------------------

EV_CTE = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts,
         epoch_us(ts) // 1000000 AS sec,
         (epoch_us(ts) // 1000000) // 60 * 60 AS bar,
         CAST(ts AS DATE) AS day,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 30 AS win,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

IST_ISO = ("strftime(make_timestamp(CAST({x} AS BIGINT) * 1000000) + INTERVAL 330 MINUTE, "
           "'%Y-%m-%dT%H:%M:%S') || '+05:30'")


_OPTION_ROWS = f"""
WITH {EV_CTE.strip()},
runs AS (
  SELECT ev.*, 1 AS ingest_run, CAST(0.5 AS DOUBLE) AS bump FROM ev
  UNION ALL
  SELECT ev.*, 2 AS ingest_run, CAST(0.75 AS DOUBLE) AS bump FROM ev
  WHERE day >= DATE '2024-01-28'),
p AS (
  SELECT *,
    row_number() OVER (PARTITION BY ingest_run, user_id, win ORDER BY ts, event_id) - 1 AS pos,
    count(*) OVER (PARTITION BY ingest_run, user_id, win) AS n,
    (user_id // 4) % 2 AS flag_idx, (user_id // 8) % 3 AS code_idx,
    user_id % 21 AS bucket_idx, (user_id // 2) % 2 AS side_idx,
    CASE WHEN user_id % 2 = 0 THEN 50 ELSE 100 END AS step,
    CASE WHEN user_id % 2 = 0 THEN CAST(20000 AS DOUBLE) ELSE CAST(70000 AS DOUBLE) END AS base
  FROM runs),
c AS (
  SELECT *,
    CASE WHEN event_type = 'error' THEN NULL ELSE base + value * CAST(10 AS DOUBLE) END AS spot,
    CASE WHEN bucket_idx <= 10 THEN bucket_idx ELSE 10 - bucket_idx END AS off,
    CASE WHEN user_id % 2 = 0 THEN 'NIFTY' ELSE 'SENSEX' END AS underlying,
    CASE WHEN side_idx = 0 THEN 'CE' ELSE 'PE' END AS option_type,
    CASE WHEN flag_idx = 0 THEN 'WEEK' ELSE 'MONTH' END AS expiry_type,
    code_idx + 1 AS expiry_code,
    win * 1000000000000000 + flag_idx * 100000000000000
      + code_idx * 10000000000000 + bucket_idx * 100000000000 + side_idx * 10000000000
      + user_id * 10000 AS request_seq
  FROM p),
d AS (
  SELECT *,
    CASE WHEN event_type = 'purchase' AND k < 30 THEN NULL
         ELSE CAST((floor((base + value * CAST(10 AS DOUBLE)) / step) + off) * step AS DOUBLE)
    END AS strike,
    CAST(round_even(spot / step, 0) AS BIGINT) * step AS atm
  FROM c),
o AS (
  SELECT bar AS ts, {IST_ISO.format(x='bar')} AS datetime,
    underlying, option_type, expiry_type, CAST(expiry_code AS TINYINT) AS expiry_code,
    CASE WHEN atm = 0 THEN NULL ELSE CAST(atm AS DOUBLE) END AS atm_strike,
    CAST(off AS TINYINT) AS strike_offset,
    CASE WHEN strike IS NOT NULL AND spot IS NOT NULL AND atm IS NOT NULL THEN
      CASE WHEN abs(strike - atm) < CAST(0.01 AS DOUBLE) THEN 'ATM'
           WHEN option_type = 'CE' THEN CASE WHEN strike < spot THEN 'ITM' ELSE 'OTM' END
           ELSE CASE WHEN strike > spot THEN 'ITM' ELSE 'OTM' END END
    ELSE '' END AS moneyness,
    strike, spot,
    CASE WHEN pos < n - user_id % 3 THEN value END AS open,
    value + CAST(1 AS DOUBLE) AS high,
    value - CAST(1 AS DOUBLE) AS low,
    value + bump AS close, bucket_idx,
    k AS volume,
    CASE WHEN user_id % 5 = 0 THEN CAST(0 AS BIGINT) ELSE event_id END AS oi,
    CASE WHEN pos < n - 1 THEN value / CAST(100 AS DOUBLE) END AS iv,
    ingest_run, request_seq, pos, user_id
  FROM d)"""
OPTION_ROWS_SQL = _OPTION_ROWS


CANDLE_ROWS_CTE = f"""
WITH {EV_CTE.strip()},
r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, win ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY user_id, win) AS n
  FROM ev)"""

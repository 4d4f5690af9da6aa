"""Flagship: option candle enrichment and newest-wins upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsmith.operators.dedupe import keep_last
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import OPTION_ROWS_SQL, RUN_ORDER, option_candles, register
from barsmith.schemas import OPTION_CANDLE, OPTION_KEYS


@register("option_enrich", OPTION_ROWS_SQL + """
SELECT ts, datetime, underlying, option_type, expiry_type, expiry_code, atm_strike,
       strike_offset, moneyness, strike, spot, open, high, low, close, volume, oi, iv
FROM (SELECT *, row_number() OVER (
        PARTITION BY ts, underlying, option_type, expiry_type, expiry_code, strike
        ORDER BY ingest_run DESC, request_seq DESC, pos DESC) AS rn FROM o)
WHERE rn = 1
""")
def option_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: landed option responses (a stored run plus a re-fetch) ->
    explode (null fill) -> ATM / offset / moneyness -> typed -> newest row
    per option-candle key."""
    responses = V.option_batches(V.table(spark, sf_dir, "events"))
    candles = option_candles(responses)
    return keep_last(candles, OPTION_KEYS, RUN_ORDER).select(*OPTION_CANDLE.names)

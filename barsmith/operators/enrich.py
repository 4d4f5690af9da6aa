"""Option candle enrichment and typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith import functions as X
from barsmith.schemas import OPTION_CANDLE


def enrich_options(rows: DataFrame, step_col: str = "strike_step",
                   bucket_col: str = "bucket") -> DataFrame:
    """Add datetime, ATM strike, offset and moneyness to exploded option rows.

    Moneyness uses the raw ATM (a zero ATM still counts) while the stored
    ``atm_strike`` turns 0 into null, as in the original job.
    """
    atm = X.atm_strike(F.col("spot"), F.col(step_col))
    return (rows
            .withColumn("_atm", atm)
            .withColumn("datetime", X.epoch_to_ist_iso("ts"))
            .withColumn("moneyness", X.guarded_moneyness("option_type", "strike", "spot", "_atm"))
            .withColumn("atm_strike", X.stored_atm("_atm"))
            .withColumn("strike_offset", X.strike_offset(bucket_col))
            .drop("_atm"))


def cast_option_candles(df: DataFrame, extra: list[str] | tuple = ()) -> DataFrame:
    """Project onto OPTION_CANDLE types (P13, P14); volume/oi nulls -> 0."""
    cols = []
    for f in OPTION_CANDLE.fields:
        c = F.col(f.name)
        if f.name in ("volume", "oi"):
            c = F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *extra)

"""Coverage report (R1): planned minus observed, and the re-request list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barsmith import functions as X
from barsmith.session import spread


def coverage_gaps(observed: DataFrame, entity: str, day: str) -> DataFrame:
    """Days between an entity's first and last observed day that have no
    observed row, each as a one-day re-request ``[day, day + 1)``.

    The planned grid is generated per entity from its span (bounded by the
    date range) and compared with an anti join on ``(entity, day)``; the
    observed side is de-duplicated first (map-side partial distinct)."""
    obs = observed.select(entity, day).distinct()
    spans = obs.groupBy(entity).agg(F.min(day).alias("_s"), F.max(day).alias("_e"))
    planned = spread(spans, entity).select(entity, F.explode(F.sequence("_s", "_e")).alias(day))
    gaps = planned.join(obs, [entity, day], "left_anti")
    return gaps.select(entity, F.col(day).alias("from_date"),
                       F.date_add(day, 1).alias("to_date"))


def combo_gaps(planned: DataFrame, stored: DataFrame) -> DataFrame:
    """Planned option requests (``plans.manifest.option_requests``) for which
    the store holds no candle: the re-request list by underlying, window, flag,
    code, bucket and side (R1). Gaps before the first and after the last stored
    day count too, as the grid comes from the plan.

    The stored candles are reduced to their distinct (combination, IST day)
    first; days meet windows by an equi-join on the combination followed by a
    range condition, and the result is an anti join of the plan."""
    side = F.when(F.col("option_type") == "CE", F.lit("CALL")).otherwise(F.lit("PUT"))
    seen = stored.select(
        F.col("underlying").alias("_u"), side.alias("_s"), F.col("expiry_type").alias("_t"),
        F.col("expiry_code").alias("_c"), F.col("strike_offset").cast("int").alias("_o"),
        X.epoch_to_ist_date("ts").alias("_day")).distinct()
    offset = X.strike_offset("bucket").cast("int")
    same = ((F.col("underlying") == F.col("_u")) & (F.col("side") == F.col("_s"))
            & (F.col("expiry_type") == F.col("_t")) & (F.col("expiry_code") == F.col("_c"))
            & (offset == F.col("_o")) & (F.col("_day") >= F.col("from_date"))
            & (F.col("_day") < F.col("to_date")))
    return planned.join(seen, same, "left_anti")


def gap_ranges(gaps: DataFrame, entity: str, max_days: int) -> DataFrame:
    """One-day gaps (``coverage_gaps``) merged to maximal ranges ``[from, to)`` and
    these cut to request windows of ``max_days``: consecutive days share the
    difference of day and rank. ``gap`` numbers an entity's maximal ranges,
    ``window_idx`` the windows of each."""
    rank = F.row_number().over(Window.partitionBy(entity).orderBy("from_date"))
    islands = gaps.select(entity, "from_date", F.date_sub("from_date", rank).alias("_island"))
    ranges = islands.groupBy(entity, "_island").agg(
        F.min("from_date").alias("_f"), F.date_add(F.max("from_date"), 1).alias("_t"))
    number = F.row_number().over(Window.partitionBy(entity).orderBy("_f"))
    return ranges.select(entity, number.alias("gap"), "_f", "_t").select(
        entity, "gap", F.inline(X.date_windows("_f", "_t", max_days)))


def combo_counts(planned: DataFrame, stored: DataFrame) -> DataFrame:
    """Per underlying and window of the plan: requests planned, those with at least
    one stored candle, those without (R1, A6)."""
    window = ["underlying", "window_idx", "from_date", "to_date"]
    combo = ["expiry_type", "expiry_code", "bucket", "side"]
    missing = combo_gaps(planned, stored).select(*window, *combo, F.lit(1).alias("_gap"))
    n = F.count(F.lit(1))
    return planned.join(missing, [*window, *combo], "left").groupBy(*window).agg(
        n.alias("n_planned"), F.count_if(F.col("_gap").isNull()).alias("n_stored"), F.count("_gap").alias("n_missing"))

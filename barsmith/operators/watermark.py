"""Stored high watermark and resume point."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from barsmith import functions as X


def high_watermark(stored: DataFrame, entity: str, ts: str = "ts") -> DataFrame:
    """``max(ts)`` per entity over the whole store (map-side partial max; only
    the two columns are read)."""
    return stored.groupBy(entity).agg(F.max(ts).alias("last_ts"))


def resume_plan(entities: DataFrame, watermarks: DataFrame, entity: str,
                default_start: _dt.date | Column, as_of: Column) -> DataFrame:
    """Per entity: start on the IST day of the stored ``max(ts)`` (that day
    is fetched again; duplicates fall to the upsert), else the default start;
    ``needs_fetch`` is false once start >= as_of (F6)."""
    start_default = default_start if isinstance(default_start, Column) else F.lit(default_start)
    j = entities.join(watermarks, entity, "left")
    resume = X.epoch_to_ist_date("last_ts")
    start = F.coalesce(resume, start_default)
    return j.select("*", resume.alias("resume_date"), start.alias("start_date"),
                    as_of.alias("end_date"), (start < as_of).alias("needs_fetch"))

"""Run summary per entity (A5, R6): what a run brought and what it changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith.operators.dedupe import nan_keys_to_null, upsert

COUNTS = ["rows_in", "keys_new", "keys_replaced", "rows_out"]


def incoming_counts(existing: DataFrame, batch: DataFrame, entity: str,
                    keys: list[str]) -> DataFrame:
    """Per entity of the batch: ``rows_in``, ``keys_new`` (keys absent from
    ``existing``) and ``keys_replaced`` (keys already there). One partial
    aggregate per (entity, key) feeds all three; only key columns are read.
    Keys compare as in the upsert: null equals null, and NaN is null."""
    per_key = nan_keys_to_null(batch.select(*dict.fromkeys([entity, *keys])), keys) \
        .groupBy(*dict.fromkeys([entity, *keys])).agg(F.count(F.lit(1)).alias("_n"))
    stored = nan_keys_to_null(existing.select(*keys), keys).distinct() \
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_stored"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    flagged = per_key.join(stored, same, "left")
    return flagged.groupBy(entity).agg(
        F.sum("_n").alias("rows_in"),
        F.count(F.when(F.col("_stored").isNull(), 1)).alias("keys_new"),
        F.count(F.when(F.col("_stored"), 1)).alias("keys_replaced"))


def combine(incoming: DataFrame, owned: DataFrame, entity: str) -> DataFrame:
    """Incoming counts and ``rows_out`` per entity in one row (full outer
    join: entities with stored rows only appear through ``rows_out``)."""
    j = incoming.join(owned, entity, "full")
    return j.select(entity, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTS])


def summarize_run(existing: DataFrame, batch: DataFrame, entity: str, keys: list[str],
                  order: list[str]) -> DataFrame:
    """Per entity: ``rows_in`` (batch rows), ``keys_new`` (batch keys absent
    from the store), ``keys_replaced`` (batch keys already stored) and
    ``rows_out`` (rows the entity owns after the upsert)."""
    owned = upsert(existing, batch, keys, order).groupBy(entity) \
        .agg(F.count(F.lit(1)).alias("rows_out"))
    return combine(incoming_counts(existing, batch, entity, keys), owned, entity)

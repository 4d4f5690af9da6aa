"""Partitioned Parquet store with newest-wins upsert.

Layout: one dataset per kind (spot, stocks, options); the entity is a column
and the physical partition is the IST day (``trade_date``) or IST month
(``trade_month``) of ``ts`` -- whichever partition column the store schema
has. An upsert reads only the partitions present in the batch (partition
pruning), merges them with the batch, keeps the newest row per key and
rewrites just those partitions with dynamic partition overwrite. The
partition value is a function of ``ts``, which is part of every key, so equal
keys always meet in the same partition. Day partitions keep the rewrite of a
daily incremental run to the days it touches, which matters once a month of
candles is large; month partitions suit small stores. Partitions commit one
by one; a repeated run heals a partial one because the upsert is idempotent
(rows are ranked by stored columns, never by arrival).
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from barsmith import functions as X
from barsmith.operators.dedupe import keep_last, keep_last_by_partition
from barsmith.operators.summary import combine, incoming_counts
from barsmith.schemas import PARTITION_COLUMN
from barsmith.session import scratch_path


PARTITION_COLUMNS = {"day": "trade_date", "month": "trade_month"}
_PARTITION_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def partition_value(ts: str | Column = "ts", granularity: str = "month") -> Column:
    """IST day (``yyyy-MM-dd``) or IST month (``yyyy-MM``) of epoch seconds."""
    return F.date_format(X.ist_wall_time(ts), _PARTITION_FORMATS[granularity])


def trade_month(ts: str | Column = "ts") -> Column:
    return partition_value(ts, "month")


def trade_date(ts: str | Column = "ts") -> Column:
    return partition_value(ts, "day")


BUCKET_COLUMN = "symbol_bucket"


def symbol_bucket(entity: str | Column, buckets: int) -> Column:
    """The bucket of an entity: a second partition level, so that reading one
    entity lists and opens one bucket's files instead of every file."""
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")


def read_entity(spark: SparkSession, path: str, schema: StructType, entity: str, value: str,
                buckets: int | None = None) -> DataFrame:
    """One entity's rows (S8). ``buckets`` is the number the store was written
    with, if it has the bucket level: the filter on it prunes partitions, the
    filter on the entity is pushed into the scan."""
    rows = read_store(spark, path, schema).where(F.col(entity) == value)
    if buckets and BUCKET_COLUMN in schema.names:
        number = spark.range(1).select(symbol_bucket(F.lit(value), buckets)).first()[0]
        rows = rows.where(F.col(BUCKET_COLUMN) == number)
    return rows


def read_entities(spark: SparkSession, path: str, schema: StructType, entity: str, entities: DataFrame,
                  buckets: int | None = None) -> DataFrame:
    """The rows of all entities of a table (S8). Where the store has the bucket
    level, the join is on bucket and entity: a table that Spark broadcasts by
    its size prunes the buckets to open at run time. A larger one is joined
    by shuffle, over all buckets. Empty names are no entities."""
    rows = read_store(spark, path, schema)
    names = entities.select(entity).where(F.length(entity) > 0)
    on = [entity]
    if buckets and BUCKET_COLUMN in schema.names:
        names, on = names.withColumn(BUCKET_COLUMN, symbol_bucket(entity, buckets)), [BUCKET_COLUMN, entity]
    return rows.join(names, on, "left_semi").select(*schema.names)


def partition_columns(schema: StructType) -> list[str]:
    """The time partition and, where the schema has it, the symbol bucket."""
    return [partition_column(schema), *(c for c in schema.names if c == BUCKET_COLUMN)]


def partition_column(schema: StructType) -> str:
    """The store's partition column: ``trade_date`` or ``trade_month``."""
    for col in ("trade_date", PARTITION_COLUMN):
        if col in schema.names:
            return col
    raise ValueError("store schema needs a trade_date or trade_month column")


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, via the Hadoop FileSystem of the path's
    scheme; None when the JVM is not reachable from Python (Spark Connect)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                    .exists(hpath))
    except Exception:  # noqa: BLE001 - no classic JVM gateway
        return None


def read_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored dataset, or an empty frame of the same schema when the path
    does not exist yet (S5). The schema is given, never inferred."""
    if path_exists(spark, path) is False:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def partition_rows(batch: DataFrame, col: str = PARTITION_COLUMN) -> dict[str, int]:
    """Rows of every partition value of a batch. The list is bounded by the
    number of days / months in the batch, so it is safe to bring to the
    driver."""
    return {r[0]: r[1] for r in batch.groupBy(col).agg(F.count(F.lit(1))).collect()}


def stage_batch(spark: SparkSession, batch: DataFrame, schema: StructType
                ) -> tuple[DataFrame, dict[str, int], str]:
    """Write the batch once under the checkpoint folder and read it back.

    The expensive batch plan (JSON parse, explode, enrichment) then runs
    once, and a lost executor re-reads staged files instead of recomputing
    the lineage. The stage is not partitioned: one file per task, however
    many partitions a backfill spans. The touched partition values and their rows
    are counted over that single column of the staged files (a bounded list)."""
    path = scratch_path(spark, "upsert-batch")
    batch.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(schema).parquet(path)
    return staged, partition_rows(staged, partition_column(schema)), path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete our own scratch folder through the Hadoop FileSystem API (no-op
    without a JVM gateway). Used only after the data that read it is
    committed."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                    .delete(hpath, True))
    except Exception:  # noqa: BLE001
        return False


def write_partitions(df: DataFrame, path: str, sort_cols: list[str],
                     col: str | list[str] = PARTITION_COLUMN, dealt: bool = False) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are
    replaced. A ``rebalance`` by the partition column lets AQE size the
    write: small partitions are packed into one task, a large (skewed) one is
    split over several tasks, so files stay near the advisory size instead of
    one file per partition per task; ``dealt`` rows are shuffled by partition
    already. Rows are sorted by ``sort_cols`` within each file (O1)."""
    cols = [col] if isinstance(col, str) else col
    ((df if dealt else df.hint("rebalance", *cols))
       .sortWithinPartitions(*cols, *sort_cols)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", "snappy")
       .partitionBy(*cols)
       .parquet(path))


def upsert_store(spark: SparkSession, path: str, batch: DataFrame, schema: StructType,
                 keys: list[str], order: list[str], sort_cols: list[str],
                 stage: bool = True, metrics: dict | None = None,
                 entity: str | None = None, reports: dict | None = None) -> list[str]:
    """Merge ``batch`` into the store at ``path`` (U3, R7). ``schema`` is the
    stored schema including ``trade_month`` and the ordering columns.
    Returns the partitions (days or months) rewritten; an empty batch
    rewrites nothing (F7).
    When ``metrics`` is given it receives ``rows_in`` (batch rows) and
    ``rows_written`` (rows of the rewritten partitions), observed during the
    write itself (A5) -- no extra job. With ``entity`` and ``reports``,
    ``reports["entity_summary"]`` gets the per-entity run summary (R6):
    ``rows_in``, ``keys_new``, ``keys_replaced`` (against the stored keys of
    the touched partitions) and ``rows_out`` (the entity's rows in the
    rewritten partitions), staged so it does not change with later runs."""
    col = partition_column(schema)
    batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    stage_path = None
    if stage:
        batch, sizes, stage_path = stage_batch(spark, batch, schema)
    else:
        sizes = partition_rows(batch, col)
    parts = sorted(sizes)
    if not parts:
        if stage_path:
            remove_path(spark, stage_path)
        return []
    existing = read_store(spark, path, schema).where(F.col(col).isin(parts))
    obs_in, obs_out = Observation("rows_in"), Observation("rows_written")
    plain_batch = batch
    batch = batch.observe(obs_in, F.count(F.lit(1)).alias("rows_in"))
    both = existing.unionByName(batch)
    # Where ts, which decides the partition, is part of the key, rows are shuffled once.
    once = "ts" in keys and BUCKET_COLUMN not in schema.names
    if once:
        for p, n in partition_rows(existing, col).items():
            sizes[p] = sizes.get(p, 0) + n
        merged = keep_last_by_partition(both, col, keys, order, sizes)
    else:
        merged = keep_last(both, keys, order)
    merged = merged.select(*schema.names).observe(obs_out,
                                                  F.count(F.lit(1)).alias("rows_written"))
    incoming_path = summary_path = None
    if entity and reports is not None:
        # Before the write: what the batch brings per entity, from the batch
        # and the stored keys of the touched partitions (key columns only).
        incoming = incoming_counts(existing, plain_batch, entity, keys)
        if entity in keys:
            # The entity is part of the key, so after the upsert it holds its
            # stored rows plus its new keys: no scan after the write.
            held = existing.groupBy(entity).agg(F.count(F.lit(1)).alias("_held"))
            j = incoming.join(held, entity, "full")
            zero = F.lit(0).cast("bigint")
            summary = j.select(
                entity, *[F.coalesce(c, zero).alias(c) for c in
                          ["rows_in", "keys_new", "keys_replaced"]],
                (F.coalesce("_held", zero) + F.coalesce("keys_new", zero)).alias("rows_out"))
            summary_path = scratch_path(spark, "run-summary")
            summary.write.mode("overwrite").parquet(summary_path)
        else:
            incoming_path = scratch_path(spark, "run-summary-in")
            incoming.write.mode("overwrite").parquet(incoming_path)
    write_partitions(merged, path, sort_cols, partition_columns(schema), dealt=once)
    if incoming_path:
        owned = (read_store(spark, path, schema).where(F.col(col).isin(parts))
                 .groupBy(entity).agg(F.count(F.lit(1)).alias("rows_out")))
        summary_path = scratch_path(spark, "run-summary")
        combine(spark.read.parquet(incoming_path), owned, entity).write.mode("overwrite") \
            .parquet(summary_path)
    if summary_path:
        reports["entity_summary"] = spark.read.parquet(summary_path)
        reports.setdefault("scratch", []).extend(p for p in (summary_path, incoming_path) if p)
    if stage_path:
        # The store write has committed; nothing reads the staged copy now.
        remove_path(spark, stage_path)
    if metrics is not None:
        metrics.update(obs_in.get)
        metrics.update(obs_out.get)
        metrics["n_partitions"] = len(parts)
    return parts

"""Upsert, store, resume and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from barsmith import functions as X
from barsmith.operators.dedupe import upsert
from barsmith.operators.summary import summarize_run
from barsmith.operators.watermark import high_watermark, resume_plan
from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import register
from barsmith.session import scratch_path
from barsmith.sources.store import (
    BUCKET_COLUMN, read_entity, read_store, symbol_bucket, trade_month, upsert_store)


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["ingest_run", "ts", "l_partkey", "l_suppkey"]
LINE_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "ts", "ingest_run"]

LINE_BATCHES_CTE = """
WITH b AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         l_extendedprice, epoch_us(l_shipdate) // 1000000 AS ts, l_returnflag, l_shipdate,
         CAST(1 AS BIGINT) AS ingest_run
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         l_extendedprice + CAST(1 AS DOUBLE), epoch_us(l_shipdate) // 1000000, l_returnflag,
         l_shipdate, CAST(2 AS BIGINT)
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-04-01')"""


@register("upsert_keep_last", LINE_BATCHES_CTE + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, ts, ingest_run
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY ingest_run DESC, ts DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM b)
WHERE rn = 1
""")
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored run + overlapping revised run; per key the newest
    run wins, inside a run the later row (ship date, then part, supplier)."""
    run1, run2 = V.lineitem_batches(V.table(spark, sf_dir, "lineitem"))
    return upsert(run1.select(*LINE_OUT), run2.select(*LINE_OUT), LINE_KEYS, LINE_ORDER) \
        .select(*LINE_OUT)


@register("split_precedence", """
WITH b AS (
  SELECT *, epoch_us(l_shipdate) // 1000000 AS ts,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) // 90 + 1 AS INTEGER)
           AS window_idx
  FROM lineitem),
c AS (
  SELECT *, window_idx % 3 = 0 AS was_split,
         DATE '1995-01-01' + CAST((window_idx - 1) * 90 AS INTEGER) AS w_from
  FROM b),
d AS (
  SELECT *, CASE WHEN NOT was_split THEN w_from
                 WHEN CAST(l_shipdate AS DATE) < w_from + 45 THEN w_from
                 ELSE w_from + 45 END AS leaf_from
  FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, ts,
       window_idx, was_split, leaf_from
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY was_split DESC, window_idx DESC, leaf_from DESC, ts DESC, l_partkey DESC,
                 l_suppkey DESC) AS rn FROM d)
WHERE rn = 1
""")
def split_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 90-day windows from 1995-01-01; every third window
    was answered as splittable and re-fetched as two halves. Split rows come
    after all direct rows, then by window, then by the half's start day."""
    c = V.lineitem_candles(V.table(spark, sf_dir, "lineitem"))
    origin = F.lit("1995-01-01").cast("date")
    day = F.to_date("l_shipdate")
    widx = (F.floor(F.datediff(day, origin) / 90) + 1).cast("int")
    c = c.select("*", widx.alias("window_idx"))
    w_from = F.date_add(origin, (F.col("window_idx") - 1) * 90)
    mid = F.date_add(w_from, 45)  # bisection of a 90-day window
    c = c.select("*", (F.col("window_idx") % 3 == 0).alias("was_split"),
                 w_from.alias("w_from"))
    c = c.withColumn("leaf_from", F.when(~F.col("was_split"), F.col("w_from"))
                     .when(day < mid, F.col("w_from")).otherwise(mid))
    out = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
           "l_extendedprice", "ts", "window_idx", "was_split", "leaf_from"]
    return upsert(None, c.select(*out), LINE_KEYS,
                  ["was_split", "window_idx", "leaf_from", "ts", "l_partkey", "l_suppkey"]) \
        .select(*out)


STORE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("ingest_run", T.LongType()),
    T.StructField("trade_month", T.StringType()),
])
BUCKETED_SCHEMA = T.StructType([*STORE_SCHEMA.fields, T.StructField(BUCKET_COLUMN, T.IntegerType())])
READ_BUCKETS = 8
STORE_KEYS = ["l_orderkey", "l_linenumber", "ts"]
STORE_ORDER = ["ingest_run", "l_partkey", "l_suppkey"]


def _resume_batch(spark: SparkSession, path: str, lineitem: DataFrame) -> DataFrame:
    """Run 2 of the store fixtures: per supplier, everything from the IST day
    of its stored max(ts) on (that day again), revised prices; suppliers
    with nothing stored start from the default day."""
    stored = read_store(spark, path, STORE_SCHEMA)
    ents = lineitem.select("l_suppkey").distinct()
    plan = resume_plan(ents, high_watermark(stored, "l_suppkey"), "l_suppkey",
                       F.lit("1992-01-01").cast("date"), X.as_of_date("2100-01-01"))
    c = V.lineitem_candles(lineitem)
    return (c.join(plan.select("l_suppkey", "start_date"), "l_suppkey")
            .where(F.to_date("l_shipdate") >= F.col("start_date"))
            .withColumn("l_extendedprice", F.col("l_extendedprice") + 1.0)
            .withColumn("ingest_run", F.lit(2).cast("bigint"))
            .withColumn("trade_month", trade_month("ts")))


def _store_two_runs(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> str:
    li = V.table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "lineitem-store")
    schema = BUCKETED_SCHEMA if buckets else STORE_SCHEMA

    def shaped(batch: DataFrame) -> DataFrame:
        return batch.withColumn(BUCKET_COLUMN, symbol_bucket("symbol", buckets)) if buckets else batch

    run1 = (V.lineitem_candles(li)
            .where(F.col("l_shipdate") < F.lit(V.LINE_CUTOFF).cast("timestamp_ntz"))
            .withColumn("ingest_run", F.lit(1).cast("bigint"))
            .withColumn("trade_month", trade_month("ts")))
    # These batches are plain Parquet scans, cheaper to recompute than to
    # stage; the ingest jobs (JSON parse + explode) keep the default staging.
    upsert_store(spark, path, shaped(run1), schema, STORE_KEYS, STORE_ORDER, ["symbol", "ts"],
                 stage=False)
    # a batch without rows rewrites nothing.
    none = upsert_store(spark, path, shaped(run1.where("l_orderkey < 0")), schema, STORE_KEYS, STORE_ORDER,
                        ["symbol", "ts"], stage=False)
    if none:
        raise RuntimeError(f"an empty batch rewrote {none}")
    upsert_store(spark, path, shaped(_resume_batch(spark, path, li)), schema, STORE_KEYS,
                 STORE_ORDER, ["symbol", "ts"], stage=False)
    return path


STORE_ORACLE_CTE = """
WITH r1 AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'),
wm AS (SELECT l_suppkey, CAST(max(l_shipdate) AS DATE) AS resume FROM r1 GROUP BY l_suppkey),
b AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_returnflag, epoch_us(l_shipdate) // 1000000 AS ts, CAST(1 AS BIGINT) AS ingest_run
  FROM r1
  UNION ALL
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
         l.l_extendedprice + CAST(1 AS DOUBLE), l.l_returnflag,
         epoch_us(l.l_shipdate) // 1000000, CAST(2 AS BIGINT)
  FROM lineitem l LEFT JOIN wm ON wm.l_suppkey = l.l_suppkey
  WHERE CAST(l.l_shipdate AS DATE) >= coalesce(wm.resume, DATE '1992-01-01')),
s AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ts
                   ORDER BY ingest_run DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM b)
  WHERE rn = 1)"""


@register("upsert_dataset", STORE_ORACLE_CTE + """
SELECT 'S' || l_suppkey AS symbol, ts, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_returnflag, ingest_run,
       strftime(make_timestamp(ts * 1000000) + INTERVAL 330 MINUTE, '%Y-%m') AS trade_month
FROM s
""")
def upsert_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs through a partitioned Parquet
    store -- run 1 into an empty store, run 2 resumed per supplier from the
    stored watermark day -- read back whole."""
    return read_store(spark, _store_two_runs(spark, sf_dir), STORE_SCHEMA)


@register("store_order", STORE_ORACLE_CTE + """
SELECT strftime(make_timestamp(ts * 1000000) + INTERVAL 330 MINUTE, '%Y-%m') AS trade_month,
       count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order
FROM s GROUP BY 1
""")
def store_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: per month, the stored rows, and how many of them come in their file
    before a row that sorts lower by (symbol, ts)."""
    return out_of_order(spark.read.schema(STORE_SCHEMA).parquet(_store_two_runs(spark, sf_dir)))


#: Rows of a file that are compared in one group.
ORDER_BLOCK = 50_000


def out_of_order(stored: DataFrame, block: int = ORDER_BLOCK) -> DataFrame:
    """Rows by month, and those that come after a row that sorts higher. A file is
    compared in blocks of rows, whatever its size: the last row of a block is sent to
    the next one too, where it is compared with the first and not counted."""
    rows = stored.select("trade_month", F.struct("symbol", "ts").alias("k"), F.col("_metadata.file_path").alias("f"),
                         F.col("_metadata.row_index").alias("i"))
    own = F.floor(F.col("i") / block)
    blocks = F.when(F.col("i") % block == block - 1, F.array(own, own + 1)).otherwise(F.array(own))
    rows = rows.select("trade_month", "k", "f", "i", own.alias("own"), F.explode(blocks).alias("b"))
    before = F.lag("k").over(Window.partitionBy("f", "b").orderBy("i"))
    return rows.select("trade_month", "own", "b", (before > F.col("k")).alias("late")).where("own = b") \
        .groupBy("trade_month").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_out_of_order"))


@register("read_symbol", STORE_ORACLE_CTE + """
SELECT 'S' || l_suppkey AS symbol, ts, l_orderkey, l_linenumber, l_extendedprice, ingest_run
FROM s WHERE l_suppkey = 7
""")
def read_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer read of one symbol. The store has a symbol bucket below
    the month, so the read opens one bucket of every month only."""
    path = _store_two_runs(spark, sf_dir, READ_BUCKETS)
    return read_entity(spark, path, BUCKETED_SCHEMA, "symbol", "S7", READ_BUCKETS).select(
        "symbol", "ts", "l_orderkey", "l_linenumber", "l_extendedprice", "ingest_run")


@register("run_summary", LINE_BATCHES_CTE + """
, old AS (SELECT DISTINCT l_orderkey, l_linenumber FROM b WHERE ingest_run = 1),
new AS (SELECT * FROM b WHERE ingest_run = 2),
nk AS (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM new),
fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY ingest_run DESC, ts DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM b)
        WHERE rn = 1),
sup AS (SELECT DISTINCT l_suppkey FROM b)
SELECT sup.l_suppkey,
  coalesce((SELECT count(*) FROM new WHERE new.l_suppkey = sup.l_suppkey), 0) AS rows_in,
  coalesce((SELECT count(*) FROM nk WHERE nk.l_suppkey = sup.l_suppkey
            AND NOT EXISTS (SELECT 1 FROM old WHERE old.l_orderkey = nk.l_orderkey
                            AND old.l_linenumber = nk.l_linenumber)), 0) AS keys_new,
  coalesce((SELECT count(*) FROM nk WHERE nk.l_suppkey = sup.l_suppkey
            AND EXISTS (SELECT 1 FROM old WHERE old.l_orderkey = nk.l_orderkey
                        AND old.l_linenumber = nk.l_linenumber)), 0) AS keys_replaced,
  coalesce((SELECT count(*) FROM fin WHERE fin.l_suppkey = sup.l_suppkey), 0) AS rows_out
FROM sup
""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier, for the second run: rows in, keys new to the
    store, keys that replace stored ones, and rows owned after the upsert."""
    run1, run2 = V.lineitem_batches(V.table(spark, sf_dir, "lineitem"))
    return summarize_run(run1.select(*LINE_OUT), run2.select(*LINE_OUT), "l_suppkey",
                         LINE_KEYS, LINE_ORDER)

"""Reading many symbols: pruned buckets and clustered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.plans import driver_views as V
from barsmith.plans.queries.common import register
from barsmith.plans.queries.store import BUCKETED_SCHEMA, READ_BUCKETS, STORE_SCHEMA
from barsmith.session import scratch_path
from barsmith.sources.clustered import ClusteredStore
from barsmith.sources.store import (
    BUCKET_COLUMN, partition_columns, read_entities, symbol_bucket, trade_month, write_partitions)

#: The symbols that are read: the suppliers of one nation. Times: two years.
NATION = 7
FIRST_TS, LAST_TS = 757382400, 820454399  # 1994-01-01 to 1995-12-31, UTC
ROWS_PER_FILE = 40_000

LINE_ROWS_SQL = """
SELECT 'S' || l_suppkey AS symbol, epoch_us(l_shipdate) // 1000000 AS ts, l_orderkey, l_linenumber,
  l_extendedprice, strftime(l_shipdate + INTERVAL 330 MINUTE, '%Y-%m') AS trade_month
FROM lineitem"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.lineitem_candles(V.table(spark, sf_dir, "lineitem")) \
        .withColumn("ingest_run", F.lit(1).cast("bigint")).withColumn("trade_month", trade_month("ts"))


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol table of a consumer, written as such."""
    path = scratch_path(spark, "symbols")
    V.table(spark, sf_dir, "supplier").where(F.col("s_nationkey") == NATION) \
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol")).write.parquet(path)
    return spark.read.schema("symbol string").parquet(path)


def _clustered(spark: SparkSession, sf_dir: str) -> ClusteredStore:
    store = ClusteredStore(spark, scratch_path(spark, "clustered"), STORE_SCHEMA, "symbol", ROWS_PER_FILE)
    store.write(_rows(spark, sf_dir))
    return store


OUT = ["symbol", "ts", "l_orderkey", "l_linenumber", "l_extendedprice", "trade_month"]


@register("read_symbols", f"""
WITH r AS ({LINE_ROWS_SQL})
SELECT * FROM r WHERE symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_nationkey = {NATION})
""")
def read_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All symbols of a table from a store with symbol buckets, which the
    table prunes at run time."""
    path = scratch_path(spark, "bucketed")
    rows = _rows(spark, sf_dir).withColumn(BUCKET_COLUMN, symbol_bucket("symbol", READ_BUCKETS))
    write_partitions(rows.select(*BUCKETED_SCHEMA.names), path, ["symbol", "ts"], partition_columns(BUCKETED_SCHEMA))
    return read_entities(spark, path, BUCKETED_SCHEMA, "symbol", _symbols(spark, sf_dir), READ_BUCKETS).select(*OUT)


@register("clustered_read", f"""
WITH r AS ({LINE_ROWS_SQL})
SELECT * FROM r WHERE symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_nationkey = {NATION})
  AND ts BETWEEN {FIRST_TS} AND {LAST_TS}
""")
def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols of a table over two years from clustered files;
    the index says which files to open."""
    return _clustered(spark, sf_dir).read(_symbols(spark, sf_dir), FIRST_TS, LAST_TS).select(*OUT)


@register("clustered_index", f"""
WITH r AS ({LINE_ROWS_SQL})
SELECT symbol, trade_month, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows FROM r GROUP BY ALL
""")
def clustered_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: time range and rows of every symbol and month from the index alone."""
    return _clustered(spark, sf_dir).index().groupBy("symbol", "trade_month").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.sum("n_rows").alias("n_rows"))

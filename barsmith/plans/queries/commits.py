"""The commit-logged store: landing order, merge on read, log watermarks and
planning from them (W1, U3, S6, R7, A1, J7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith.plans import driver_views as V
from barsmith.plans import jobs as J
from barsmith.plans.queries.common import CANDLE_ROWS_CTE, register
from barsmith.plans.queries.ingest_jobs import written
from barsmith.plans.queries.reports import _line, _manifest
from barsmith.plans.queries.store import STORE_KEYS, STORE_ORDER, STORE_SCHEMA
from barsmith.session import scratch_path
from barsmith.sources.commit_log import CommitStore
from barsmith.sources.store import trade_month


def request_key() -> Column:
    return F.concat_ws("-", "symbol", F.col("win").cast("string"))


def land_closes(resp: DataFrame, change: float, path: str) -> None:
    """Good answers whose closes are changed by a constant."""
    none = F.lit(None).cast("string")
    closes = F.transform("close_full", lambda x: (x.cast("double") + F.lit(change)).cast("string"))
    resp.withColumn("close_full", closes).select(
        _line(request_key(), F.lit(200), none, none, resp).alias("value")).write.mode("append").text(path)


#: The landings of one run: which users' answers come again, and with what closes.
LANDINGS = [(1, 0.0), (2, 10.0), (3, -7.0)]
LANDED_CLOSE = "value + CAST(0.5 AS DOUBLE) + CASE WHEN user_id % 3 = 0 THEN CAST(-7 AS DOUBLE) " \
    "WHEN user_id % 2 = 0 THEN CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


@register("landing_order", CANDLE_ROWS_CTE + f"""
SELECT 'U' || user_id AS symbol, sec AS ts, value AS open, {LANDED_CLOSE} AS close,
  CAST(CASE WHEN user_id % 3 = 0 THEN 3 WHEN user_id % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS landing
FROM r
""")
def landing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's requests are answered up to three times, each landing
    ingested on its own: the candle that landed last stays, larger or smaller."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "landing-order")
    manifest = written(_manifest(resp, "stocks"), f"{root}/manifest")
    for every, change in LANDINGS:
        land_closes(resp.where(F.col("user_id") % every == 0), change, f"{root}/landing-{every}")
        J.ingest_candles(spark, "stocks", manifest, f"{root}/landing-{every}", f"{root}/store")
    store = J.open_store(spark, f"{root}/store", J.CANDLE_STORE)
    return store._merged(landing=True).select("symbol", "ts", "open", "close", "landing")


def line_store(spark: SparkSession, path: str, max_segments: int) -> CommitStore:
    return CommitStore(spark, path, STORE_SCHEMA, STORE_KEYS, STORE_ORDER, ["symbol", "ts"], "symbol", max_segments)


COMMITS = 4


def _line_commits(spark: SparkSession, sf_dir: str) -> tuple[CommitStore, list[dict]]:
    """Line items in commits over all months: all of them, then line numbers from
    2 on, from 3 on and from 4 on again, with a higher price each time. Months are
    rewritten as one segment at the fourth commit."""
    rows = V.lineitem_candles(V.table(spark, sf_dir, "lineitem")) \
        .withColumn("ingest_run", F.lit(1).cast("bigint")).withColumn("trade_month", trade_month("ts"))
    store = line_store(spark, scratch_path(spark, "line-commits"), COMMITS - 1)
    counts = []
    for i in range(COMMITS):
        own = rows.where(F.col("l_linenumber") > i) if i else rows
        counts.append({})
        store.upsert(own.withColumn("l_extendedprice", F.col("l_extendedprice") + float(i)), metrics=counts[-1],
                     stage=False)
    return store, counts


_LINE_COMMITS = """
WITH c AS (SELECT *, epoch_us(l_shipdate) // 1000000 AS ts,
  strftime(l_shipdate + INTERVAL 330 MINUTE, '%Y-%m') AS trade_month,
  least(l_linenumber, 4) AS last FROM lineitem)"""


@register("merge_on_read", _LINE_COMMITS + """
SELECT 'S' || l_suppkey AS symbol, ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice + CAST(last - 1 AS DOUBLE) AS l_extendedprice, l_returnflag, CAST(1 AS BIGINT) AS ingest_run, trade_month
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ts
        ORDER BY l_partkey DESC, l_suppkey DESC) AS rn FROM c) WHERE rn = 1
""")
def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits that each write their own rows only, over all months; rows
    of one key are merged when read, and a month with three segments is rewritten."""
    return _line_commits(spark, sf_dir)[0].read()


@register("write_amplification", _LINE_COMMITS + """
, n AS (SELECT DISTINCT l_orderkey, l_linenumber, ts, trade_month, last FROM c),
a AS (SELECT unnest([1, 2, 3, 4]) AS k),
m AS (SELECT k, trade_month, count(*) FILTER (last >= k) AS own, count(*) AS held FROM n, a GROUP BY ALL),
s AS (SELECT *, count(*) FILTER (own > 0) OVER (PARTITION BY trade_month ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS before FROM m)
SELECT CAST(k AS INTEGER) AS commit, CAST((SELECT count(*) FROM c WHERE last >= k) AS BIGINT) AS rows_in,
  CAST(sum(CASE WHEN own = 0 THEN 0 WHEN before >= 3 THEN held ELSE own END) AS BIGINT) AS rows_written,
  CAST(count(*) FILTER (own > 0) AS BIGINT) AS n_partitions,
  CAST(count(*) FILTER (own > 0 AND before >= 3) AS BIGINT) AS n_rewritten
FROM s GROUP BY k
""")
def write_amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each commit brought and wrote, and partitions it rewrote."""
    _, counts = _line_commits(spark, sf_dir)
    values = ", ".join(f"({i + 1}, {c['rows_in']}L, {c['rows_written']}L, {c['n_partitions']}L, {c['n_rewritten']}L)"
                       for i, c in enumerate(counts))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(commit, rows_in, rows_written, n_partitions, n_rewritten)")


@register("log_watermark", """
SELECT 'S' || l_suppkey AS symbol, max(epoch_us(l_shipdate) // 1000000) AS last_ts FROM lineitem GROUP BY l_suppkey
""")
def log_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the largest stored ts per supplier from the commit log; no stored row
    is read."""
    rows = V.lineitem_candles(V.table(spark, sf_dir, "lineitem")) \
        .withColumn("ingest_run", F.lit(1).cast("bigint")).withColumn("trade_month", trade_month("ts"))
    store = line_store(spark, scratch_path(spark, "line-watermarks"), 8)
    for cut in (rows.where("l_linenumber % 2 = 0"), rows.where("l_linenumber % 2 = 1")):
        store.upsert(cut)
    return store.watermarks()

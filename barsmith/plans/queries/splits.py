"""Whole bisection trees, splits of splits over several runs, and missing days as
ranges and counts (X11, R3, N4, R1, A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith.operators.coverage import combo_counts as _counts, coverage_gaps, gap_ranges
from barsmith.plans import driver_views as V
from barsmith.plans import jobs as J
from barsmith.plans import manifest as M
from barsmith.plans.queries.common import CANDLE_ROWS_CTE, OPTION_ROWS_SQL, option_candles, register
from barsmith.plans.queries.ingest_jobs import written
from barsmith.plans.queries.manifests import _SPANS_CTE, _customer_spans
from barsmith.plans.queries.reports import _line, _manifest
from barsmith.session import scratch_path

#: The oracle's recursion; a node's place in the tree is its path of halves.
_TREE_CTE = "WITH RECURSIVE" + _SPANS_CTE.strip()[len("WITH"):] + """
, t AS (
  SELECT o_custkey, max_days, window_idx, from_date, to_date, '' AS path FROM x
  WHERE date_diff('day', from_date, to_date) > 1
  UNION ALL
  SELECT o_custkey, max_days, window_idx,
    CASE h WHEN 0 THEN from_date ELSE from_date + CAST(date_diff('day', from_date, to_date) // 2 AS INTEGER) END,
    CASE h WHEN 1 THEN to_date ELSE from_date + CAST(date_diff('day', from_date, to_date) // 2 AS INTEGER) END,
    path || h
  FROM t, (VALUES (0), (1)) AS v(h)
  WHERE date_diff('day', from_date, to_date) > CASE max_days WHEN 90 THEN 1 ELSE 7 END)"""


@register("split_tree", _TREE_CTE + """
SELECT o_custkey, max_days, window_idx, count(*) AS n_leaves,
  string_agg(from_date || '/' || date_diff('day', from_date, to_date), ' ' ORDER BY path) AS leaves,
  min(CAST(window_idx AS BIGINT) * 100000 + date_diff('day', DATE '1970-01-01', from_date) % 100000) AS first_seq,
  max(CAST(window_idx AS BIGINT) * 100000 + date_diff('day', DATE '1970-01-01', from_date) % 100000) AS last_seq
FROM t WHERE date_diff('day', from_date, to_date) <= CASE max_days WHEN 90 THEN 1 ELSE 7 END
GROUP BY ALL
""")
def split_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 90-day window halved down to single days and every
    30-day window down to a week or less: its leaves (first day and length) from
    left to right, as a recursion visits them, and their places in the order."""
    spans = _customer_spans(spark, sf_dir)
    text = lambda x: F.concat_ws("/", x["from_date"].cast("string"),
                                 F.datediff(x["to_date"], x["from_date"]).cast("string"))
    # A window is one row with its whole tree: nothing has to meet by key again.
    asked = lambda x: [F.size(x).cast("bigint").alias("n_leaves"),
                       F.array_join(F.transform(x, text), " ").alias("leaves"),
                       F.array_min(x["request_seq"]).alias("first"), F.array_max(x["request_seq"]).alias("last")]
    trees = [M.split_tree(M.window_rows(spans, "s", "e", days, ["o_custkey"]), ["o_custkey"], leaf, nested=True,
                          asked=asked, usual=days).withColumn("max_days", F.lit(days)) for days, leaf in ((90, 1), (30, 7))]
    return trees[0].unionByName(trees[1]).select(
        "o_custkey", "max_days", "window_idx", "n_leaves", "leaves",
        (M.window_seq() + F.col("first")).alias("first_seq"), (M.window_seq() + F.col("last")).alias("last_seq"))


def _answers(manifest: DataFrame, events: DataFrame, change: Column, path: str) -> None:
    """Land good answers with all bars of a request's days, the last included."""
    bars = V.event_bars(events).select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                                       "ts", "event_id", "sec", "value", "day")
    own = manifest.select("request_id", "symbol", "from_date", "to_date", change.alias("change"))
    e = bars.join(own, "symbol").where(F.col("day").between(F.col("from_date"), F.col("to_date")))
    got = e.groupBy("request_id").agg(F.array_sort(F.collect_list(
        F.struct("ts", "event_id", "sec", "value", "change"))).alias("el"))
    cells = lambda f: F.transform("el", lambda x: f(x).cast("string"))
    value = lambda x: x["value"] + 0.5 + x["change"]
    body = got.select("request_id", cells(lambda x: x["sec"]).alias("timestamp"),
                      *[cells(value).alias(c) for c in ("open_full", "high", "low", "close_full")],
                      cells(lambda x: F.lit(1)).alias("volume_short"))
    none = F.lit(None).cast("string")
    body.select(_line(F.col("request_id"), F.lit(200), none, none, body).alias("value")).write.mode("append").text(path)


def _too_long(manifest: DataFrame, path: str) -> None:
    manifest.select(_line(F.col("request_id"), F.lit(400), F.lit("DH-906"), F.lit("Too long"), None).alias("value")) \
        .write.mode("append").text(path)


@register("split_runs", CANDLE_ROWS_CTE + """
, o AS (SELECT *, date_diff('day', DATE '2024-01-01', day) % 30 AS d FROM r)
SELECT 'U' || user_id AS symbol, sec AS ts, value + CAST(0.5 AS DOUBLE)
  + CASE WHEN d < 7 THEN CAST(20 AS DOUBLE) WHEN d < 15 THEN CAST(30 AS DOUBLE) ELSE CAST(10 AS DOUBLE) END AS close
FROM o
""")
def split_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that are too long, whose right halves answer in the
    second run and whose left halves, too long again, answer as quarters in the
    third. Pieces share their boundary days; the piece further right wins there,
    also where a later run brought the one on its left."""
    events = V.table(spark, sf_dir, "events")
    root = scratch_path(spark, "split-runs")
    manifest = written(_manifest(V.intraday_responses(events), "stocks"), f"{root}/manifest-1")
    days = F.datediff("to_date", "from_date")
    offset = F.datediff("from_date", F.lit(V.FIRST_DAY).cast("date")) % 30
    for run in (1, 2, 3):
        landing = f"{root}/landing-{run}"
        if run == 1:
            _too_long(manifest, landing)
        else:
            left = (offset == 0) if run == 2 else F.lit(False)
            _too_long(manifest.where(left), landing)
            change = F.when(days == 15, 10.0).when(offset == 0, 20.0).otherwise(30.0)
            _answers(manifest.where(~left), events, change, landing)
        res = J.ingest_candles(spark, "stocks", manifest, landing, f"{root}/store")
        if run < 3:
            manifest = written(J.next_run_split_manifest(res.split_manifest, "stocks", run + 1),
                               f"{root}/manifest-{run + 1}")
    return J.read_store(spark, f"{root}/store", J.CANDLE_STORE).select("symbol", "ts", "close")


GAP_WINDOW = 5


@register("coverage_ranges", f"""
WITH o AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id % 3 <> 0 OR day(ts) % 4 = 1),
n AS (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next FROM o),
g AS (SELECT user_id, day + 1 AS f, next AS t, row_number() OVER (PARTITION BY user_id ORDER BY day) AS gap
  FROM n WHERE next > day + 1),
w AS (SELECT *, unnest(range(0, (date_diff('day', f, t) + {GAP_WINDOW - 1}) // {GAP_WINDOW})) AS i FROM g)
SELECT user_id, CAST(gap AS INTEGER) AS gap, CAST(i + 1 AS INTEGER) AS window_idx,
  f + CAST(i * {GAP_WINDOW} AS INTEGER) AS from_date, least(f + CAST((i + 1) * {GAP_WINDOW} AS INTEGER), t) AS to_date
FROM w
""")
def coverage_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the days without a candle as maximal ranges, cut to request
    windows; a third of the users has candles on every fourth day only."""
    ev = V.event_bars(V.table(spark, sf_dir, "events"))
    seen = ev.where((F.col("user_id") % 3 != 0) | (F.dayofmonth("day") % 4 == 1)).select("user_id", "day")
    return gap_ranges(coverage_gaps(seen, "user_id", "day"), "user_id", GAP_WINDOW)


@register("combo_counts", OPTION_ROWS_SQL + """
, seen AS (SELECT DISTINCT underlying, option_type, expiry_type, expiry_code, bucket_idx,
    date_diff('day', DATE '2024-01-01', CAST(make_timestamp(ts * 1000000) + INTERVAL 330 MINUTE AS DATE)) // 30 AS w
  FROM o WHERE ingest_run = 1),
pl AS (SELECT u, w FROM (VALUES ('NIFTY'), ('SENSEX')) AS a(u), (VALUES (0), (1)) AS b(w)),
n AS (SELECT underlying, w, count(*) AS n FROM seen GROUP BY ALL)
SELECT u AS underlying, CAST(pl.w + 1 AS INTEGER) AS window_idx, DATE '2024-01-01' + CAST(pl.w * 30 AS INTEGER) AS from_date,
  DATE '2024-01-01' + CAST(pl.w * 30 + 30 AS INTEGER) AS to_date, CAST(252 AS BIGINT) AS n_planned,
  coalesce(n, 0) AS n_stored, 252 - coalesce(n, 0) AS n_missing
FROM pl LEFT JOIN n ON n.underlying = u AND n.w = pl.w
""")
def combo_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests planned, answered with candles, and missing, by underlying
    and window."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1)
    ents = spark.createDataFrame([(u, V.FIRST_DAY) for u in ("NIFTY", "SENSEX")], "underlying string, s string")
    ents = ents.select("underlying", F.to_date("s").alias("s"), F.date_add(F.to_date("s"), 60).alias("e"))
    return _counts(M.option_requests(ents, "s", "e", ["underlying"]), option_candles(resp))

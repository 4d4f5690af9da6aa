"""Manifests, windows and resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import functions as X
from barsmith.operators.watermark import high_watermark, resume_plan
from barsmith.plans import driver_views as V
from barsmith.plans import manifest as M
from barsmith.plans.queries.common import register


_SPANS_CTE = """
WITH b AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
  FROM orders GROUP BY o_custkey),
w AS (
  SELECT o_custkey, m AS max_days, s, e,
         unnest(range(0, (date_diff('day', s, e) + m - 1) // m)) AS i
  FROM b, (VALUES (30), (90)) AS t(m) WHERE s < e),
x AS (
  SELECT o_custkey, max_days, CAST(i + 1 AS INTEGER) AS window_idx,
         s + CAST(i * max_days AS INTEGER) AS from_date,
         least(s + CAST((i + 1) * max_days AS INTEGER), e) AS to_date
  FROM w)"""


def _customer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("s"),
                                      F.to_date(F.max("o_orderdate")).alias("e"))


@register("date_windows", _SPANS_CTE + """
SELECT o_custkey, max_days, window_idx, from_date, to_date,
       CAST(from_date AS VARCHAR) || ' 00:00:00' AS from_text,
       CAST(to_date AS VARCHAR) || ' 23:59:59' AS to_text
FROM x
""")
def date_windows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first-to-last order span cut into 30- and
    90-day windows, with candle-style text bounds."""
    spans = _customer_spans(spark, sf_dir)
    parts = []
    for days in (30, 90):
        w = M.window_rows(spans, "s", "e", days, ["o_custkey"])
        f_txt, t_txt = X.candle_window_text("from_date", "to_date")
        parts.append(w.select("o_custkey", F.lit(days).alias("max_days"), "window_idx",
                              "from_date", "to_date", f_txt.alias("from_text"),
                              t_txt.alias("to_text")))
    return parts[0].unionByName(parts[1])


@register("range_bisect", _SPANS_CTE + """
, h AS (
  SELECT o_custkey, window_idx, from_date, to_date,
         from_date + CAST(date_diff('day', from_date, to_date) // 2 AS INTEGER) AS mid
  FROM x WHERE max_days = 90 AND date_diff('day', from_date, to_date) > 1)
SELECT o_custkey, window_idx, 0 AS half, from_date, mid AS to_date,
       CAST(from_date AS VARCHAR) || ' 00:00:00' AS from_text,
       CAST(mid AS VARCHAR) || ' 23:59:59' AS to_text FROM h
UNION ALL
SELECT o_custkey, window_idx, 1 AS half, mid AS from_date, to_date,
       CAST(mid AS VARCHAR) || ' 00:00:00' AS from_text,
       CAST(to_date AS VARCHAR) || ' 23:59:59' AS to_text FROM h
""")
def range_bisect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 90-day window longer than one day, answered as
    splittable, becomes two half-range requests sharing the middle day."""
    w = M.window_rows(_customer_spans(spark, sf_dir), "s", "e", 90, ["o_custkey"])
    return M.split_requests(w, ["o_custkey"])


GRID_AS_OF = "2001-08-02"
GRID_DEFAULT_START = "1998-01-01"


@register("request_grid", f"""
WITH st AS (
  SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS resume FROM orders GROUP BY o_custkey),
ent AS (
  SELECT c.c_custkey, coalesce(st.resume, DATE '{GRID_DEFAULT_START}') AS s,
         DATE '{GRID_AS_OF}' AS e
  FROM customer c LEFT JOIN st ON st.o_custkey = c.c_custkey),
w AS (
  SELECT c_custkey, s, e, unnest(range(0, (date_diff('day', s, e) + 29) // 30)) AS i
  FROM ent WHERE s < e),
x AS (SELECT i, s + CAST(i * 30 AS INTEGER) AS f, least(s + CAST((i + 1) * 30 AS INTEGER), e) AS t FROM w),
n AS (SELECT count(*) AS n, CAST(sum(i + 1) AS BIGINT) AS w, min(i) AS lo, max(i) AS hi, min(f) AS f,
        max(t) AS t, CAST(sum(date_diff('day', f, t)) AS BIGINT) AS d FROM x),
fl AS (SELECT unnest(['WEEK', 'MONTH']) AS flag, unnest([0, 1]) AS fi),
co AS (SELECT unnest([1, 2, 3]) AS code), bu AS (SELECT unnest(range(0, 21)) AS bi),
si AS (SELECT unnest(['CALL', 'PUT']) AS side, unnest([0, 1]) AS si)
SELECT flag AS expiry_type, CAST(code AS TINYINT) AS expiry_code,
  CASE WHEN bi = 0 THEN 'ATM' WHEN bi <= 10 THEN 'ATM+' || bi ELSE 'ATM-' || (bi - 10) END AS bucket,
  side, n AS n_requests, w AS sum_window_idx, d AS n_days,
  CAST(lo * 252 + ((fi * 3 + code - 1) * 21 + bi) * 2 + si AS BIGINT) AS min_seq,
  CAST(hi * 252 + ((fi * 3 + code - 1) * 21 + bi) * 2 + si AS BIGINT) AS max_seq,
  CAST(f AS VARCHAR) AS first_from, CAST(t AS VARCHAR) AS last_to
FROM n, fl, co, bu, si
""")
def request_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options manifest per customer -- resume from the day of
    its last order (else a default start) to a fixed as-of date, 30-day windows
    x 252 combos -- and what is planned for each combo over all customers."""
    stored = V.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), X.epoch_seconds("o_orderdate").alias("ts"))
    ents = V.table(spark, sf_dir, "customer").select("c_custkey")
    plan = resume_plan(ents, high_watermark(stored, "c_custkey"), "c_custkey",
                       F.lit(GRID_DEFAULT_START).cast("date"),
                       X.as_of_date(GRID_AS_OF))
    # The stored day is an IST day; order dates are midnight UTC, so the IST
    # day equals the order date.
    reqs = M.option_requests(plan.where("needs_fetch"), "start_date", "end_date", ["c_custkey"])
    per_combo = reqs.groupBy("expiry_type", "expiry_code", "bucket", "side").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.sum(F.col("window_idx").cast("bigint")).alias("sum_window_idx"),
        F.sum(F.datediff("to_date", "from_date").cast("bigint")).alias("n_days"),
        F.min("request_seq").alias("min_seq"), F.max("request_seq").alias("max_seq"),
        F.min("from_date").alias("f"), F.max("to_date").alias("t"))
    f_txt, t_txt = X.option_window_text("f", "t")
    return per_combo.select("expiry_type", "expiry_code", "bucket", "side", "n_requests", "sum_window_idx",
                            "n_days", "min_seq", "max_seq", f_txt.alias("first_from"), t_txt.alias("last_to"))


WATERMARK_AS_OF = "2024-01-20"
WATERMARK_DEFAULT = "2024-01-01"


@register("watermark", f"""
WITH wm AS (
  SELECT user_id, max(epoch_us(ts) // 1000000) AS last_ts FROM events GROUP BY user_id),
j AS (
  SELECT c.c_custkey, wm.last_ts,
         CAST(make_timestamp(wm.last_ts * 1000000) + INTERVAL 330 MINUTE AS DATE) AS resume_date
  FROM customer c LEFT JOIN wm ON wm.user_id = c.c_custkey)
SELECT c_custkey, last_ts, resume_date,
       coalesce(resume_date, DATE '{WATERMARK_DEFAULT}') AS start_date,
       DATE '{WATERMARK_AS_OF}' AS end_date,
       coalesce(resume_date, DATE '{WATERMARK_DEFAULT}') < DATE '{WATERMARK_AS_OF}' AS needs_fetch
FROM j
""")
def watermark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per entity (customer = user), the IST day of the
    last stored event is the resume day, else the default start; entities
    whose start is not before the as-of date need no fetch."""
    ev = V.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("c_custkey"), X.epoch_seconds("ts").alias("ts"))
    ents = V.table(spark, sf_dir, "customer").select("c_custkey")
    return resume_plan(ents, high_watermark(ev, "c_custkey"), "c_custkey",
                       F.lit(WATERMARK_DEFAULT).cast("date"), X.as_of_date(WATERMARK_AS_OF))

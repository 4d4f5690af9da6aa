"""Reports and plans of the jobs as queries: triage outputs, run summaries, the
spot job, request manifests and per-combination coverage (R1-R4, R6, J5-J7, N10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith import config as C
from barsmith.operators.coverage import combo_gaps
from barsmith.plans import driver_views as V
from barsmith.plans import jobs as J
from barsmith.plans.queries.common import CANDLE_ROWS_CTE, EV_CTE, IST_ISO, OPTION_ROWS_SQL, \
    option_candles, register, strike_step
from barsmith.plans.queries.ingest_jobs import written
from barsmith.session import scratch_path

#: What becomes of a user's answer in the triage fixture, by user_id % 11.
FAIL, SPLIT, NO_DATA, UNREADABLE, UNANSWERED, TWICE, BAD_TS = range(1, 8)


def _manifest(resp: DataFrame, kind: str) -> DataFrame:
    return resp.select(
        F.concat_ws("-", "symbol", F.col("win").cast("string")).alias("request_id"),
        F.lit(1).cast("bigint").alias("ingest_run"), F.col("win").alias("request_seq"),
        "symbol", F.col("user_id").cast("string").alias("security_id"),
        F.lit(C.INDEX_EXCHANGE_SEGMENT if kind == "spot" else C.NSE_EQ).alias("segment"),
        F.lit(C.INDEX_INSTRUMENT_TYPE if kind == "spot" else C.EQUITY).alias("instrument"),
        (F.col("win") + 1).cast("int").alias("window_idx"),
        V.window_start(F.col("win")).alias("from_date"),
        V.window_start(F.col("win") + 1).alias("to_date"))


def _line(rid: Column, status: Column, code: Column, message: Column, body: DataFrame | None,
          timestamp: Column | None = None) -> Column:
    """A landed JSON line."""
    cells = [] if body is None else [
        (F.col("timestamp") if timestamp is None else timestamp).alias("timestamp"),
        F.col("open_full").alias("open"), "high", "low", F.col("close_full").alias("close"),
        F.col("volume_short").alias("volume")]
    return F.to_json(F.struct(rid.alias("request_id"), status.alias("status"),
                              code.alias("errorCode"), message.alias("errorMessage"), *cells))


def _land_mixed(resp: DataFrame, path: str) -> None:
    """Answers of every kind; those of kind TWICE fail first and succeed later,
    in one landing folder."""
    rid, kind, none = F.concat_ws("-", "symbol", F.col("win").cast("string")), F.col("user_id") % 11, \
        F.lit(None).cast("string")
    good = _line(rid, F.lit(200), none, none, resp)
    failed = _line(rid, F.lit(500), F.lit("DH-904"), F.lit("Rate limit"), None)
    bad_ts = _line(rid, F.lit(200), none, none, resp, F.concat(
        F.array(F.lit("soon")), F.slice("timestamp", 2, F.greatest(F.size("timestamp") - 1, F.lit(0)))))
    lines = (F.when(kind == FAIL, F.array(failed))
             .when(kind == SPLIT, F.array(_line(rid, F.lit(400), F.lit("DH-906"), F.lit("Too long"), None)))
             .when(kind == NO_DATA, F.array(_line(rid, F.lit(400), F.lit("DH-905"), F.lit("No data present"), None)))
             .when(kind == UNREADABLE, F.array(F.concat(F.lit('{"request_id": "'), rid)))
             .when(kind == UNANSWERED, F.array().cast("array<string>"))
             .when(kind == TWICE, F.array(failed, good))
             .when(kind == BAD_TS, F.array(bad_ts)).otherwise(F.array(good)))
    resp.select(F.explode(lines).alias("value")).write.mode("overwrite").text(path)


_TRIAGE_CTE = f"""
WITH {EV_CTE.strip()},
g AS (SELECT user_id, win, user_id % 11 AS kind, 'U' || user_id AS symbol,
        'U' || user_id || '-' || win AS rid,
        DATE '2024-01-01' + CAST(win * 30 AS INTEGER) AS f,
        DATE '2024-01-01' + CAST(win * 30 + 15 AS INTEGER) AS m,
        DATE '2024-01-01' + CAST(win * 30 + 30 AS INTEGER) AS t
      FROM ev GROUP BY user_id, win)"""


@register("triage_outputs", _TRIAGE_CTE + """
SELECT 'quarantine' AS report, CASE WHEN kind <> 4 THEN rid END AS request_id,
  CASE WHEN kind <> 4 THEN symbol END AS symbol,
  CASE kind WHEN 1 THEN 'fail' WHEN 4 THEN 'orphan' WHEN 6 THEN 'superseded' ELSE 'bad_ts' END AS outcome,
  CAST(NULL AS DATE) AS from_date, CAST(NULL AS DATE) AS to_date,
  CAST(CASE kind WHEN 7 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM g WHERE kind IN (1, 4, 6, 7)
UNION ALL
SELECT 'rerequest', rid, symbol, CASE kind WHEN 1 THEN 'fail' WHEN 7 THEN 'bad_ts' ELSE 'missing' END,
  f, t, 0 FROM g WHERE kind IN (1, 4, 5, 7)
UNION ALL
SELECT 'split', NULL, symbol, 'split', f, m, 0 FROM g WHERE kind = 2
UNION ALL
SELECT 'split', NULL, symbol, 'split', m, t, 0 FROM g WHERE kind = 2
UNION ALL
SELECT 'summary', NULL, symbol,
  CASE kind WHEN 1 THEN 'fail' WHEN 2 THEN 'split' WHEN 3 THEN 'no_data' WHEN 4 THEN 'missing'
            WHEN 5 THEN 'missing' WHEN 7 THEN 'bad_ts' ELSE 'ok' END,
  NULL, NULL, count(*) FROM g GROUP BY symbol, kind
""")
def triage_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock answers of every kind -- good, failed, too long, no
    data, unreadable, missing, answered twice, bad timestamps -- through the
    ingest job: its quarantine, re-request list, split manifest and summary."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "triage-job")
    _land_mixed(resp, f"{root}/landing")
    manifest = written(_manifest(resp, "stocks"), f"{root}/manifest")
    res = J.ingest_candles(spark, "stocks", manifest, f"{root}/landing", f"{root}/store")
    text, day, zero = F.lit(None).cast("string"), F.lit(None).cast("date"), F.lit(0).cast("bigint")
    counts = F.explode(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("n"))
                                 for o in J.OUTCOMES])).alias("c")
    parts = [
        res.quarantine.select(F.lit("quarantine").alias("report"), "request_id", "symbol", "outcome",
                              day.alias("from_date"), day.alias("to_date"), F.col("n_bad_ts").alias("n")),
        res.rerequest.select(F.lit("rerequest").alias("report"), "request_id", "symbol", "outcome",
                             "from_date", "to_date", zero.alias("n")),
        res.split_manifest.select(F.lit("split").alias("report"), text.alias("request_id"), "symbol",
                                  F.lit("split").alias("outcome"), "from_date", "to_date", zero.alias("n")),
        res.summary.select("symbol", counts).where("c.n > 0").select(
            F.lit("summary").alias("report"), text.alias("request_id"), "symbol",
            F.col("c.outcome").alias("outcome"), day.alias("from_date"), day.alias("to_date"),
            F.col("c.n").alias("n"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("ingest_spot_job", CANDLE_ROWS_CTE + f"""
SELECT 'U' || user_id AS symbol, sec AS ts, {IST_ISO.format(x='sec')} AS datetime,
  value AS open, value + CAST(1 AS DOUBLE) AS high, value - CAST(1 AS DOUBLE) AS low,
  value + CAST(0.5 AS DOUBLE) AS close, CASE WHEN pos < n - user_id % 3 THEN k ELSE 0 END AS volume
FROM r
""")
def ingest_spot_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spot ingest job end to end (strict arrays, padded volume): landed
    JSON lines and a manifest into a fresh store, read back."""
    resp = V.intraday_responses(V.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "spot-job")
    none = F.lit(None).cast("string")
    resp.select(_line(F.concat_ws("-", "symbol", F.col("win").cast("string")), F.lit(200), none, none, resp)
                .alias("value")).write.mode("overwrite").text(f"{root}/landing")
    manifest = written(_manifest(resp, "spot"), f"{root}/manifest")
    J.ingest_candles(spark, "spot", manifest, f"{root}/landing", f"{root}/store")
    return J.consumer_view(J.read_store(spark, f"{root}/store", J.CANDLE_STORE)).drop("trade_date")


@register("ingest_options_summary", OPTION_ROWS_SQL + """
, k AS (SELECT underlying, count(*) AS c FROM (SELECT DISTINCT ts, underlying, option_type, expiry_type,
          expiry_code, strike FROM o WHERE ingest_run = 1) GROUP BY underlying),
n AS (SELECT underlying, count(*) AS c, min(ts) AS t FROM o WHERE ingest_run = 1 GROUP BY underlying),
a AS (SELECT unnest([1, 2]) AS attempt)
SELECT CAST(attempt AS INTEGER) AS attempt, underlying, n.c AS rows_in,
  CASE WHEN attempt = 1 THEN k.c ELSE 0 END AS keys_new,
  CASE WHEN attempt = 1 THEN 0 ELSE k.c END AS keys_replaced, k.c AS rows_out,
  DATE '2024-01-01' AS resume_date
FROM a, k JOIN n USING (underlying)
""")
def ingest_options_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary of the options job, and that of a second run on
    the same answers, which must add no key, null strikes included."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1)
    rid = F.concat_ws("-", F.col("request_seq").cast("string"), F.col("user_id").cast("string"))
    root = scratch_path(spark, "options-summary")
    resp.select(rid.alias("request_id"), F.lit(200).alias("status"), "data") \
        .write.mode("overwrite").json(f"{root}/landing")
    manifest = written(resp.select(
        rid.alias("request_id"), "ingest_run", "request_seq", "underlying", "side",
        "expiry_type", "expiry_code", "bucket", strike_step(F.col("underlying")).alias("strike_step"),
        V.window_start(F.col("win")).alias("from_date"),
        V.window_start(F.col("win") + 1).alias("to_date")), f"{root}/manifest")
    runs = [J.ingest_options(spark, manifest, f"{root}/landing", f"{root}/store").run_summary
            for _ in range(2)]
    one, two = (r.select(F.lit(i + 1).alias("attempt"), "*") for i, r in enumerate(runs))
    return one.unionByName(two)


# ------------------------------------------------------------------ plans

PLAN_AS_OF = dt.date(2025, 3, 20)


def index_master(part: DataFrame) -> DataFrame:
    """``part_master`` with index names: every tenth part is a NIFTY 50 row,
    every tenth a SENSEX row, with traps (NIFTY 500, BANK NIFTY 50)."""
    key = F.col("row_seq") % 10
    name = (F.when(key == 0, F.lit("NIFTY 500")).when(key == 1, F.lit("BANK NIFTY 50"))
            .when(key == 2, F.lit("Nifty")).when(key == 3, F.lit("S&P BSE SENSEX"))
            .when(key == 4, F.lit("SENSEX MIDCAP")).otherwise(F.col("DISPLAY_NAME")))
    return V.part_master(part).withColumn("DISPLAY_NAME", name).withColumn("SYMBOL_NAME", F.lit(""))


_INDEX_CTE = """
m AS (
  SELECT p_partkey AS row_seq, CAST(p_partkey AS VARCHAR) AS sid,
    CASE p_partkey % 10 WHEN 0 THEN 'NIFTY 500' WHEN 1 THEN 'BANK NIFTY 50' WHEN 2 THEN 'NIFTY'
      WHEN 3 THEN 'S&P BSE SENSEX' WHEN 4 THEN 'SENSEX MIDCAP' ELSE upper(p_name) END AS text,
    CASE WHEN p_size % 3 IN (0, 1) THEN 'NSE' ELSE 'BSE' END AS exch
  FROM part WHERE p_type IN ('PROMO', 'STANDARD', 'LARGE', 'SMALL')),
s AS (
  SELECT 'NIFTY' AS ent, sid, row_seq, exch = 'NSE' AS own,
    CASE WHEN contains(text, 'NIFTY 50') THEN 2 WHEN contains(text, 'NIFTY') THEN 1 END AS score
  FROM m WHERE NOT (contains(text, 'BANK') OR contains(text, 'FIN') OR contains(text, 'MIDCAP')
                    OR contains(text, 'NEXT 50') OR contains(text, 'IT'))
  UNION ALL
  SELECT 'SENSEX', sid, row_seq, exch = 'BSE',
    CASE WHEN contains(text, 'SENSEX') THEN 2 END
  FROM m WHERE NOT (contains(text, 'MIDCAP') OR contains(text, 'SMALLCAP'))),
ids AS (SELECT ent, sid FROM (SELECT *, row_number() OVER (PARTITION BY ent
          ORDER BY score + CAST(own AS INTEGER) DESC, row_seq) AS rn FROM s WHERE score IS NOT NULL)
        WHERE rn = 1)"""


def _windows_sql(ents: str, days: int) -> str:
    return f"""
w AS (SELECT *, unnest(range(0, (date_diff('day', s, DATE '{PLAN_AS_OF}') + {days - 1}) // {days})) AS i
      FROM {ents} WHERE s < DATE '{PLAN_AS_OF}'),
x AS (SELECT *, CAST(i + 1 AS INTEGER) AS window_idx, s + CAST(i * {days} AS INTEGER) AS f,
        least(s + CAST((i + 1) * {days} AS INTEGER), DATE '{PLAN_AS_OF}') AS t FROM w)"""


_STORED_CTE = """
st AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'NIFTY' ELSE 'SENSEX' END AS ent,
         CAST(make_timestamp(max(epoch_us(ts) // 1000000) * 1000000) + INTERVAL 330 MINUTE AS DATE) AS d
       FROM events GROUP BY 1)"""


def _stored(spark: SparkSession, rows: DataFrame, path: str, schema) -> str:
    """A store that one commit filled with ``rows`` (entity and ``ts``); the other
    columns hold defaults."""
    part = J.partition_value("ts", "day").alias("trade_date")
    zero = {"bigint": F.lit(0), "int": F.lit(0), "tinyint": F.lit(0), "double": F.lit(0.0), "string": F.lit("")}
    own = rows.select("*", part)
    full = own.select(*[F.col(f.name) if f.name in own.columns else
                        zero[f.dataType.simpleString()].cast(f.dataType).alias(f.name) for f in schema.fields])
    J.open_store(spark, path, schema).upsert(full)
    return path


def _stored_entities(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Entities that last saw data at their last event."""
    ev = V.event_bars(V.table(spark, sf_dir, "events"))
    return ev.select(F.when(F.col("user_id") % 2 == 0, "NIFTY").otherwise("SENSEX").alias(entity),
                     F.col("sec").alias("ts"))


@register("plan_spot_job", f"WITH {_INDEX_CTE.strip()}, {_STORED_CTE.strip()}, "
          f"e AS (SELECT ids.ent, sid, coalesce(d, DATE '{C.SPOT_START_DATE}') AS s FROM ids LEFT JOIN st "
          f"ON st.ent = ids.ent), {_windows_sql('e', 90).strip()}" + f"""
SELECT 'spot|' || ent || '|' || f || '|' || t || '|7' AS request_id, CAST(7 AS BIGINT) AS ingest_run,
  CAST(window_idx AS BIGINT) AS request_seq, ent AS symbol, sid AS security_id, 'IDX_I' AS segment,
  'INDEX' AS instrument, window_idx, f AS from_date, t AS to_date,
  f || ' 00:00:00' AS from_text, t || ' 23:59:59' AS to_text
FROM x
""")
def plan_spot_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spot manifest, index ids resolved from the master,
    windows from the day of the stored maximum."""
    root = scratch_path(spark, "plan-spot")
    store = _stored(spark, _stored_entities(spark, sf_dir, "symbol"), f"{root}/store", J.CANDLE_STORE)
    return J.plan_spot_requests(spark, index_master(V.table(spark, sf_dir, "part")), store, PLAN_AS_OF, 7)


@register("plan_options_job", f"WITH {_INDEX_CTE.strip()}, {_STORED_CTE.strip()}, "
          f"e AS (SELECT ids.ent, sid, coalesce(d, DATE '{C.OPTIONS_START_DATE}') AS s FROM ids LEFT JOIN st "
          f"ON st.ent = ids.ent), "
          f"{_windows_sql('e', 30).strip()}" + """
, fl AS (SELECT unnest(['WEEK', 'MONTH']) AS flag, unnest([0, 1]) AS fi),
co AS (SELECT unnest([1, 2, 3]) AS code),
bu AS (SELECT unnest(range(0, 21)) AS bi),
si AS (SELECT unnest(['CALL', 'PUT']) AS side, unnest([0, 1]) AS si),
c AS (SELECT *, CASE WHEN bi = 0 THEN 'ATM' WHEN bi <= 10 THEN 'ATM+' || bi ELSE 'ATM-' || (bi - 10) END AS bucket,
        ((fi * 3 + code - 1) * 21 + bi) * 2 + si AS combo FROM fl, co, bu, si)
SELECT 'options|' || ent || '|' || f || '|' || flag || '|' || code || '|' || bucket || '|' || side || '|7'
    AS request_id, CAST(7 AS BIGINT) AS ingest_run, CAST(i * 252 + combo AS BIGINT) AS request_seq,
  ent AS underlying, sid AS security_id, CASE ent WHEN 'NIFTY' THEN 'NSE_FNO' ELSE 'BSE_FNO' END AS segment,
  CASE ent WHEN 'NIFTY' THEN 50 ELSE 100 END AS strike_step, 'OPTIDX' AS instrument, window_idx,
  f AS from_date, t AS to_date, CAST(f AS VARCHAR) AS from_text, CAST(t AS VARCHAR) AS to_text,
  flag AS expiry_type, CAST(code AS TINYINT) AS expiry_code, bucket, side
FROM x, c
""")
def plan_options_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The options manifest, all columns, all 252
    combinations of every window from the day of the stored maximum."""
    root = scratch_path(spark, "plan-options")
    store = _stored(spark, _stored_entities(spark, sf_dir, "underlying"), f"{root}/store", J.OPTION_STORE)
    return J.plan_option_requests(spark, index_master(V.table(spark, sf_dir, "part")), store, PLAN_AS_OF, 7)


@register("plan_stocks_job", f"""
WITH m AS (
  SELECT p_partkey AS row_seq, CAST(p_partkey AS VARCHAR) AS sid, p_type = 'ECONOMY' AS is_eq, p_name AS u
  FROM part WHERE p_size % 3 IN (0, 1) AND p_size <= 45),
st AS (SELECT p_name AS n, max(DATE '2024-01-01' + CAST(p_partkey % 500 AS INTEGER)) AS d FROM part
  WHERE p_partkey % 3 = 0 GROUP BY p_name),
e AS (SELECT u AS ent, sid, coalesce(d, DATE '{C.STOCKS_START_DATE}') AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY u ORDER BY is_eq DESC,
           CASE WHEN is_eq THEN -row_seq ELSE row_seq END) AS rn FROM m WHERE u <> '') LEFT JOIN st ON n = u WHERE rn = 1),
""" + _windows_sql("e", 90).strip() + """
SELECT 'stocks|' || ent || '|' || f || '|' || t || '|7' AS request_id, CAST(7 AS BIGINT) AS ingest_run,
  CAST(window_idx AS BIGINT) AS request_seq, ent AS symbol, sid AS security_id, 'NSE_EQ' AS segment,
  'EQUITY' AS instrument, window_idx, f AS from_date, t AS to_date,
  f || ' 00:00:00' AS from_text, t || ' 23:59:59' AS to_text
FROM x
""")
def plan_stocks_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock manifest for every part name that resolves: from
    the stored day for every third part (none where it is up to date), from the
    default day for the others."""
    root = scratch_path(spark, "plan-stocks")
    part = V.table(spark, sf_dir, "part")
    names = part.select(F.col("p_name").alias("symbol"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 500).cast("int"))
    seen = part.where("p_partkey % 3 = 0").select(F.col("p_name").alias("symbol"),
                                                  (F.unix_date(day).cast("bigint") * 86400 + 3600).alias("ts"))
    store = _stored(spark, seen, f"{root}/store", J.CANDLE_STORE)
    manifest, _ = J.plan_stock_requests(spark, V.part_master(part), store, PLAN_AS_OF, 7, names)
    return manifest


@register("combo_coverage", OPTION_ROWS_SQL + """
, seen AS (SELECT DISTINCT underlying, option_type, expiry_type, expiry_code, bucket_idx AS bi,
    date_diff('day', DATE '2024-01-01', CAST(make_timestamp(ts * 1000000) + INTERVAL 330 MINUTE AS DATE)) // 30 AS w
  FROM o
        WHERE ingest_run = 1),
u AS (SELECT unnest(['NIFTY', 'SENSEX']) AS underlying),
fl AS (SELECT unnest(['WEEK', 'MONTH']) AS expiry_type), co AS (SELECT unnest([1, 2, 3]) AS expiry_code),
bu AS (SELECT unnest(range(0, 21)) AS bi), si AS (SELECT unnest(['CALL', 'PUT']) AS side),
wi AS (SELECT unnest([0, 1]) AS w),
plan AS (SELECT *, CASE side WHEN 'CALL' THEN 'CE' ELSE 'PE' END AS option_type FROM u, fl, co, bu, si, wi)
SELECT plan.underlying, DATE '2024-01-01' + CAST(plan.w * 30 AS INTEGER) AS from_date,
  DATE '2024-01-01' + CAST(plan.w * 30 + 30 AS INTEGER) AS to_date, plan.expiry_type,
  CAST(plan.expiry_code AS TINYINT) AS expiry_code,
  CASE WHEN plan.bi = 0 THEN 'ATM' WHEN plan.bi <= 10 THEN 'ATM+' || plan.bi ELSE 'ATM-' || (plan.bi - 10) END
    AS bucket, plan.side
FROM plan LEFT JOIN seen ON seen.underlying = plan.underlying AND seen.option_type = plan.option_type
  AND seen.expiry_type = plan.expiry_type AND seen.expiry_code = plan.expiry_code AND seen.bi = plan.bi AND seen.w = plan.w
WHERE seen.bi IS NULL
""")
def combo_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned (underlying, window, flag, code, offset, side) without one
    stored candle, the window after the last stored one included."""
    resp = V.option_responses(V.table(spark, sf_dir, "events"), ingest_run=1)
    ents = spark.createDataFrame([(u, V.FIRST_DAY) for u in ("NIFTY", "SENSEX")], "underlying string, s string")
    ents = ents.select("underlying", F.to_date("s").alias("s"), F.date_add(F.to_date("s"), 60).alias("e"))
    planned = J.M.option_requests(ents, "s", "e", ["underlying"])
    return combo_gaps(planned, option_candles(resp)).select(
        "underlying", "from_date", "to_date", "expiry_type", "expiry_code", "bucket", "side")

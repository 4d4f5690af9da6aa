"""Domain inputs derived from the driver's tables.

The driver supplies TPC-H-like tables, not market data. Each function here
turns one of them into the shape a pipeline stage consumes (landed responses,
an option chain, an instrument master), with plain DataFrame expressions, so
that every registered query reads the given tables and its work grows with
them. Every derived value is a deterministic function of the row, so the DuckDB
oracle can rebuild it with the same arithmetic.

Response grouping: a response is the events of one user in one 30-day request
window, as the original job asks for them, so it holds all bars of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith import functions as X

FIRST_DAY = "2024-01-01"  # first day of the first request window
WINDOW_DAYS = 30
RERUN_FROM = "2024-01-28"  # day from which the fixture's second run re-fetches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def request_window(ts: str) -> Column:
    """Number of the 30-day request window that holds ``ts``."""
    days = F.datediff(ts, F.lit(FIRST_DAY).cast("date"))
    return F.floor(days / WINDOW_DAYS).cast("bigint")


def window_start(window: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (window * WINDOW_DAYS).cast("int"))


def event_bars(events: DataFrame) -> DataFrame:
    """Events with candle fields: epoch second, minute bar, response key."""
    sec = X.epoch_seconds("ts")
    return events.select(
        "event_id", "user_id", "event_type", "value", "ts",
        sec.alias("sec"),
        (F.expr("unix_timestamp(ts) div 60") * 60).alias("bar"),
        F.to_date("ts").alias("day"),
        request_window("ts").alias("win"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _sorted_elems(fields: list[Column]) -> Column:
    """Response elements in time order (ts, event_id lead every struct)."""
    return F.array_sort(F.collect_list(F.struct(*fields)))


def intraday_responses(events: DataFrame) -> DataFrame:
    """One response row per (user, request window): text arrays of
    timestamp/open/high/low/close/volume, in time order, plus ``n`` and the
    short-array lengths used by the zero-fill fixtures.

    ``volume`` keeps only the first ``n - user_id % 3`` values (short volume);
    ``open`` and ``close`` likewise keep ``n - user_id % 3`` and
    ``n - user_id % 2`` (short prices for the zero-fill policy).
    """
    e = event_bars(events)
    g = (e.groupBy("user_id", "win")
         .agg(_sorted_elems([F.col("ts"), F.col("event_id"), F.col("sec"), F.col("value"),
                             F.col("k")]).alias("el")))
    n = F.size("el")
    s3 = F.greatest(n - F.col("user_id") % 3, F.lit(0))
    s2 = F.greatest(n - F.col("user_id") % 2, F.lit(0))

    def txt(expr):
        return F.transform("el", lambda x: expr(x).cast("string"))

    return g.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        "user_id", "win",
        txt(lambda x: x["sec"]).alias("timestamp"),
        txt(lambda x: x["value"]).alias("open_full"),
        txt(lambda x: x["value"] + 1.0).alias("high"),
        txt(lambda x: x["value"] - 1.0).alias("low"),
        txt(lambda x: x["value"] + 0.5).alias("close_full"),
        txt(lambda x: x["k"]).alias("volume_full"),
        s3.alias("n_short3"), s2.alias("n_short2"),
    ).select(
        "symbol", "user_id", "win", "timestamp", "high", "low",
        "open_full", "close_full", "volume_full",
        F.slice("open_full", 1, F.col("n_short3")).alias("open_short"),
        F.slice("close_full", 1, F.col("n_short2")).alias("close_short"),
        F.slice("volume_full", 1, F.col("n_short3")).alias("volume_short"),
    )


# Request attributes of a user's option responses (fixture rule).
def option_request_attrs(user: Column) -> dict[str, Column]:
    flag_idx = (user.cast("bigint") / 4).cast("bigint") % 2
    code_idx = (user.cast("bigint") / 8).cast("bigint") % 3
    bucket_idx = user % 21
    side_idx = (user.cast("bigint") / 2).cast("bigint") % 2
    bucket = (F.when(bucket_idx == 0, F.lit("ATM"))
              .when(bucket_idx <= 10, F.concat(F.lit("ATM+"), bucket_idx.cast("string")))
              .otherwise(F.concat(F.lit("ATM-"), (bucket_idx - 10).cast("string"))))
    return {
        "underlying": F.when(user % 2 == 0, F.lit("NIFTY")).otherwise(F.lit("SENSEX")),
        "side": F.when(side_idx == 0, F.lit("CALL")).otherwise(F.lit("PUT")),
        "expiry_type": F.when(flag_idx == 0, F.lit("WEEK")).otherwise(F.lit("MONTH")),
        "expiry_code": (code_idx + 1).cast("tinyint"),
        "bucket": bucket,
        "flag_idx": flag_idx, "code_idx": code_idx, "bucket_idx": bucket_idx,
        "side_idx": side_idx,
    }


def option_responses(events: DataFrame, ingest_run: int = 1,
                     close_bump: float = 0.5, misplaced: bool = False) -> DataFrame:
    """One option response per (user, request window), shaped like the landed
    rolling-option body: ``data.ce`` / ``data.pe`` side structs of text arrays.

    Side arrays: spot = base + 10 * value (base 20000 / 70000 by underlying),
    ``""`` for error events; strike = (floor(spot / step) + offset) * step,
    ``""`` for purchases with k < 30; open is short by ``user_id % 3`` values,
    iv by one value, oi is absent for ``user_id % 5 = 0``. With ``misplaced``
    the arrays of ``user_id % 7 = 0`` sit under the other side's key: the
    requested side is missing and the response gives no rows (F5).
    """
    tagged = events.select("*", F.lit(ingest_run).cast("bigint").alias("ingest_run"),
                           F.lit(close_bump).alias("close_bump"))
    return _option_responses(tagged, misplaced)


def _option_responses(events: DataFrame, misplaced: bool = False) -> DataFrame:
    """``option_responses`` over events tagged with ``ingest_run`` and
    ``close_bump``; one response per (run, user, request window)."""
    e = events.select(
        "event_id", "user_id", "event_type", "value", "ts", "ingest_run", "close_bump",
        (F.expr("unix_timestamp(ts) div 60") * 60).alias("bar"),
        F.to_date("ts").alias("day"),
        request_window("ts").alias("win"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    u = F.col("user_id")
    a = option_request_attrs(u)
    step = F.when(u % 2 == 0, F.lit(50)).otherwise(F.lit(100))
    base = F.when(u % 2 == 0, F.lit(20000.0)).otherwise(F.lit(70000.0))
    offset = F.when(a["bucket_idx"] <= 10, a["bucket_idx"]).otherwise(10 - a["bucket_idx"])
    spot = base + F.col("value") * 10.0
    strike = ((F.floor(spot / step) + offset) * step).cast("double")
    e = e.select(
        "*",
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(spot.cast("string"))
        .alias("spot_txt"),
        F.when((F.col("event_type") == "purchase") & (F.col("k") < 30), F.lit(""))
        .otherwise(strike.cast("string")).alias("strike_txt"),
        (F.col("value") + F.col("close_bump")).cast("string").alias("close_txt"),
    )
    g = (e.groupBy("ingest_run", "user_id", "win")
         .agg(_sorted_elems([F.col("ts"), F.col("event_id"), F.col("bar"), F.col("value"),
                             F.col("k"), F.col("spot_txt"), F.col("strike_txt"),
                             F.col("close_txt")]).alias("el")))
    n = F.size("el")

    def txt(expr):
        return F.transform("el", lambda x: expr(x).cast("string"))

    side = F.struct(
        txt(lambda x: x["bar"]).alias("timestamp"),
        F.slice(txt(lambda x: x["value"]), 1, F.greatest(n - u % 3, F.lit(0))).alias("open"),
        txt(lambda x: x["value"] + 1.0).alias("high"),
        txt(lambda x: x["value"] - 1.0).alias("low"),
        F.transform("el", lambda x: x["close_txt"]).alias("close"),
        txt(lambda x: x["k"]).alias("volume"),
        F.when(u % 5 == 0, F.lit(None).cast("array<string>"))
        .otherwise(txt(lambda x: x["event_id"])).alias("oi"),
        F.slice(txt(lambda x: x["value"] / 100.0), 1, F.greatest(n - 1, F.lit(0))).alias("iv"),
        F.transform("el", lambda x: x["strike_txt"]).alias("strike"),
        F.transform("el", lambda x: x["spot_txt"]).alias("spot"),
    )
    null_side = F.lit(None).cast(side_type())
    other = (u % 7 == 0) if misplaced else F.lit(False)
    seq = (F.col("win") * F.lit(10 ** 15) + a["flag_idx"] * F.lit(10 ** 14)
           + a["code_idx"] * F.lit(10 ** 13) + a["bucket_idx"] * F.lit(10 ** 11)
           + a["side_idx"] * F.lit(10 ** 10) + u * F.lit(10 ** 4))
    return g.select(
        "ingest_run",
        seq.alias("request_seq"),
        "user_id", "win",
        a["underlying"].alias("underlying"), a["side"].alias("side"),
        a["expiry_type"].alias("expiry_type"), a["expiry_code"].alias("expiry_code"),
        a["bucket"].alias("bucket"),
        F.struct(F.when((a["side"] == "CALL") != other, side).otherwise(null_side).alias("ce"),
                 F.when((a["side"] == "PUT") != other, side).otherwise(null_side).alias("pe"))
        .alias("data"),
    )


def side_type() -> str:
    cells = ", ".join(f"{n}: array<string>" for n in
                      ["timestamp", "open", "high", "low", "close", "volume", "oi", "iv",
                       "strike", "spot"])
    return f"struct<{cells}>"


def option_batches(events: DataFrame) -> DataFrame:
    """Stored run plus a second run that re-fetches the days from
    ``RERUN_FROM`` on with revised closes: the re-fetched rows must win.
    Both runs come from one scan: each event is tagged with the runs it
    belongs to (a bounded generator of one or two rows) and responses are
    grouped per run in one aggregation."""
    one, two = F.lit(1).cast("bigint"), F.lit(2).cast("bigint")
    runs = F.when(F.to_date("ts") >= F.lit(RERUN_FROM).cast("date"),
                  F.array(one, two)).otherwise(F.array(one))
    tagged = events.select("*", F.explode(runs).alias("ingest_run"))
    tagged = tagged.withColumn("close_bump", F.when(F.col("ingest_run") == 2, F.lit(0.75))
                               .otherwise(F.lit(0.5)))
    return _option_responses(tagged)


def part_master(part: DataFrame) -> DataFrame:
    """``part`` as an instrument master with the real master's header names.

    INSTRUMENT_TYPE: INDEX for PROMO/STANDARD/LARGE, ``index`` (lower case)
    for SMALL, else EQUITY; SYMBOL_NAME = brand ('' for size 1);
    DISPLAY_NAME = name; EXCH_ID NSE / ``nse`` / BSE by size mod 3; INSTRUMENT
    EQUITY up to size 45, else OPTSTK; SERIES EQ for ECONOMY, else BE;
    UNDERLYING_SYMBOL = name; security id = part key; row_seq = part key.
    """
    size = F.col("p_size")
    return part.select(
        F.col("p_partkey").alias("row_seq"),
        F.when(F.col("p_type").isin("PROMO", "STANDARD", "LARGE"), F.lit("INDEX"))
        .when(F.col("p_type") == "SMALL", F.lit("index")).otherwise(F.lit("EQUITY"))
        .alias("INSTRUMENT_TYPE"),
        F.when(size == 1, F.lit("")).otherwise(F.col("p_brand")).alias("SYMBOL_NAME"),
        F.col("p_name").alias("DISPLAY_NAME"),
        F.when(size % 3 == 0, F.lit("NSE")).when(size % 3 == 1, F.lit("nse"))
        .otherwise(F.lit("BSE")).alias("EXCH_ID"),
        F.when(size > 45, F.lit("OPTSTK")).otherwise(F.lit("EQUITY")).alias("INSTRUMENT"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("EQ")).otherwise(F.lit("BE")).alias("SERIES"),
        F.col("p_name").alias("UNDERLYING_SYMBOL"),
        F.col("p_partkey").cast("string").alias("SEM_SMST_SECURITY_ID"),
    )


def requested_symbols(part: DataFrame) -> DataFrame:
    """Symbols asked for: every part name and brand (found by the first and
    the second lookup) and every upper-cased type (never found: matching is
    case-sensitive). Repeats collapse."""
    return part.select(F.explode(F.array("p_name", "p_brand", F.upper("p_type"))).alias("symbol"))


LINE_CUTOFF = "1998-06-01"


def lineitem_candles(lineitem: DataFrame) -> DataFrame:
    """Line items as versioned rows: ``ts`` = epoch second of the ship date,
    symbol = ``S<suppkey>``, ``l_partkey``/``l_suppkey`` order rows that
    share a key and a ship date (their position in a response)."""
    return lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        X.epoch_seconds("l_shipdate").alias("ts"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")


def lineitem_batches(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored run (ship date before the cutoff) and a second run from two
    months before the cutoff on, with revised prices (+1)."""
    c = lineitem_candles(lineitem)
    run1 = (c.where(F.col("l_shipdate") < F.lit(LINE_CUTOFF).cast("timestamp_ntz"))
            .withColumn("ingest_run", F.lit(1).cast("bigint")))
    run2 = (c.where(F.col("l_shipdate") >= F.lit("1998-04-01").cast("timestamp_ntz"))
            .withColumn("l_extendedprice", F.col("l_extendedprice") + 1.0)
            .withColumn("ingest_run", F.lit(2).cast("bigint")))
    return run1, run2

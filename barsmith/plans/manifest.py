"""Request manifests.

A manifest has one row per request the collector must send, with a total
``request_seq`` inside each entity that encodes the original job's request
order, so that newest-wins ranking never depends on file order (N4):

* candles: window order; split halves come from a later run (``ingest_run``)
  and are ordered by window, then by the leaf's start day;
* options: window, expiry flag, expiry code, strike bucket, side.

Everything is generated per entity row with bounded generators (the number of
windows is bounded by the date range, the option grid is 252 per window):
no join, no shuffle, no driver loop over entities.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from barsmith import functions as X
from barsmith.session import spread
from barsmith.config import (
    CANDLE_WINDOW_DAYS, EXPIRY_CODES, EXPIRY_FLAGS, OPTION_SIDES, OPTION_WINDOW_DAYS,
    STRIKE_BUCKETS,
)


def window_rows(df: DataFrame, start: str | Column, end: str | Column, max_days: int,
                keep: list[str], spread_first: bool = True) -> DataFrame:
    """One row per date window of ``[start, end)`` per input row.

    The entity frame is usually a small aggregate; it is spread over the
    shuffle partitions first so the expansion runs on every core. (By a hash of
    ``keep``: Spark leaves out a repartition by what was aggregated by already.)"""
    if spread_first:
        own = F.xxhash64(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(0)
        df = spread(df.withColumn("_spread", own), "_spread").drop("_spread")
    return df.select(*keep, F.inline(X.date_windows(start, end, max_days)))


def option_combos() -> Column:
    """The per-window option request grid in request order (J5): expiry flag,
    expiry code, strike bucket, side -- 2 x 3 x 21 x 2 = 252 entries."""
    # One parsed literal: building it field by field takes seconds of plan time.
    combos = [
        f"named_struct('expiry_type', '{flag}', 'expiry_code', {code}Y, 'bucket', '{bucket}', "
        f"'side', '{side}')"
        for flag in EXPIRY_FLAGS for code in EXPIRY_CODES for bucket in STRIKE_BUCKETS
        for side, _label in OPTION_SIDES]
    return F.expr(f"array({', '.join(combos)})")


COMBOS_PER_WINDOW = len(EXPIRY_FLAGS) * len(EXPIRY_CODES) * len(STRIKE_BUCKETS) * len(OPTION_SIDES)


def option_requests(entities: DataFrame, start: str | Column, end: str | Column,
                    keep: list[str], max_days: int = OPTION_WINDOW_DAYS) -> DataFrame:
    """Options manifest: windows x 252 combos per entity, with text bounds
    and ``request_seq = (window_idx - 1) * 252 + combo position``."""
    w = window_rows(entities, start, end, max_days, keep)
    g = w.select("*", F.posexplode(option_combos()).alias("combo_idx", "combo"))
    f_txt, t_txt = X.option_window_text("from_date", "to_date")
    return g.select(
        *keep, "window_idx", "from_date", "to_date",
        f_txt.alias("from_text"), t_txt.alias("to_text"),
        "combo.expiry_type", "combo.expiry_code", "combo.bucket", "combo.side",
        ((F.col("window_idx") - 1).cast("bigint") * COMBOS_PER_WINDOW + F.col("combo_idx"))
        .alias("request_seq"))


def candle_requests(entities: DataFrame, start: str | Column, end: str | Column,
                    keep: list[str], max_days: int = CANDLE_WINDOW_DAYS) -> DataFrame:
    """Spot / stock manifest: one request per window; bounds run from
    00:00:00 of the first day to 23:59:59 of the last day (end day included,
    so consecutive windows overlap by one day)."""
    w = window_rows(entities, start, end, max_days, keep)
    f_txt, t_txt = X.candle_window_text("from_date", "to_date")
    return w.select(*keep, "window_idx", "from_date", "to_date", f_txt.alias("from_text"),
                    t_txt.alias("to_text"),
                    F.col("window_idx").cast("bigint").alias("request_seq"))


def split_requests(failed: DataFrame, keep: list[str], option_text: bool = False) -> DataFrame:
    """Each request answered with a splittable error over more than one
    day becomes two half-range requests for the next run. Halves keep the
    top-level ``window_idx`` and are ordered by their start day (N4).
    ``option_text`` writes the bounds as plain dates."""
    mid = X.bisect_mid("from_date", "to_date")
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("from_date").alias("from_date"),
                 mid.alias("to_date")),
        F.struct(F.lit(1).alias("half"), mid.alias("from_date"), F.col("to_date").alias("to_date")))
    out = (failed.where(F.datediff("to_date", "from_date") > 1)
           .select(*keep, "window_idx", F.inline(halves)))
    text = X.option_window_text if option_text else X.candle_window_text
    f_txt, t_txt = text("from_date", "to_date")
    return out.select("*", f_txt.alias("from_text"), t_txt.alias("to_text"))


#: Longest range whose halves are followed to the end.
TREE_DAYS = 366


def split_tree(failed: DataFrame, keep: list[str], leaf_days: int = 1,
               option_text: bool = False, max_days: int = TREE_DAYS, nested: bool = False,
               asked: Callable[[Column], list[Column]] | None = None, usual: int | None = None) -> DataFrame:
    """The whole tree below requests that ask for a shorter range, down to
    leaves of at most ``leaf_days``, for the next run: ``leaf`` numbers them from
    left to right, and ``request_seq`` puts the leaves of all windows in one order
    (N4). Requests of one day have no leaves; one of more than ``max_days`` fails.
    ``nested`` gives a row per request with its ``leaves`` (without texts), so that
    what is asked of one tree needs no grouping of its leaves.

    ``asked`` gives such a row with the (named) columns it makes of ``leaves``, whose
    ``request_seq`` is then that inside the window (``window_seq`` comes on top). Most
    requests are whole windows: of ``usual`` days, they are answered once for each first
    day (a bounded broadcast: no more rows than days in the calendar), the others each."""
    days = F.datediff("to_date", "from_date")
    if asked is not None:
        within = lambda df, own: _trees(df.withColumn("window_idx", F.lit(0)), own, leaf_days, max_days)
        whole, other = failed.where(days == F.lit(usual)), failed.where(~days.eqNullSafe(F.lit(usual)))
        day = F.unix_date("from_date").alias("_day")
        once = within(whole.select("from_date", "to_date", day).distinct(), ["_day"]).select("_day", *asked(F.col("leaves")))
        found = whole.select(*keep, "window_idx", day).join(F.broadcast(once), "_day").drop("_day")
        each = within(other.withColumn("_window", F.col("window_idx")), [*keep, "_window"])
        return found.unionByName(each.select(*keep, F.col("_window").alias("window_idx"), *asked(F.col("leaves"))))
    leaves = _trees(failed, keep, leaf_days, max_days)
    if nested:
        return leaves
    out = leaves.select(*keep, "window_idx", F.inline("leaves"))
    text = X.option_window_text if option_text else X.candle_window_text
    f_txt, t_txt = text("from_date", "to_date")
    return out.select(*keep, "window_idx", "leaf", "from_date", "to_date", f_txt.alias("from_text"),
                      t_txt.alias("to_text"), "request_seq")


def _trees(failed: DataFrame, keep: list[str], leaf_days: int, max_days: int) -> DataFrame:
    """Requests with their ``leaves``. A tree depends on the number of days alone, so
    the trees of all lengths up to ``max_days`` (a row each, a bounded broadcast) are
    built once and looked up."""
    day = F.lit("2000-01-01").cast("date")
    since = lambda d: F.datediff(d, day)
    trees = failed.sparkSession.range(2, max_days + 1).select(
        F.col("id").cast("int").alias("_n"),
        F.transform(X.bisect_leaves(day, F.date_add(day, F.col("id").cast("int")), leaf_days, max_days),
                    lambda r: F.struct(since(r["from_date"]).alias("a"), since(r["to_date"]).alias("b"))).alias("_tree"))
    days = F.datediff("to_date", "from_date")
    long = F.raise_error(F.lit(f"a range of more than {max_days} days cannot be halved to its end"))
    found = failed.where(days > 1).withColumn("_n", days).join(F.broadcast(trees), "_n", "left") \
        .select(*keep, "window_idx", F.col("from_date").alias("_f"), F.coalesce("_tree", long).alias("_tree"))
    return found.select(*keep, "window_idx", F.transform("_tree", lambda r, i: F.struct(
        (i + 1).alias("leaf"), F.date_add("_f", r["a"]).alias("from_date"), F.date_add("_f", r["b"]).alias("to_date"),
        leaf_seq(F.date_add("_f", r["a"])).alias("request_seq"))).alias("leaves"))


def window_seq() -> Column:
    """Where the places of a window's split pieces begin."""
    return F.col("window_idx").cast("bigint") * 100000


def leaf_seq(from_date: str | Column = "from_date") -> Column:
    """Place of a split piece: by window, then by its first day."""
    return window_seq() + F.unix_date(from_date) % 100000

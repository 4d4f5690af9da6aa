"""Date windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_windows(start, end, max_days: int) -> Column:
    """``[start, end)`` cut into consecutive windows of ``max_days``; the last
    one is shorter and each window ends where the next begins. Empty when
    start >= end. Returns ``array<struct<window_idx, from_date, to_date>>``."""
    s, e = _col(start), _col(end)
    starts = F.sequence(s, F.date_sub(e, 1), F.expr(f"INTERVAL {int(max_days)} DAYS"))
    windows = F.transform(
        starts,
        lambda d, i: F.struct((i + 1).alias("window_idx"), d.alias("from_date"),
                              F.least(F.date_add(d, int(max_days)), e).alias("to_date")))
    return F.when(s < e, windows).otherwise(
        F.array().cast("array<struct<window_idx:int,from_date:date,to_date:date>>"))


def bisect_mid(from_date, to_date) -> Column:
    """``from + (to - from) // 2`` days (X11)."""
    f = _col(from_date)
    return F.date_add(f, F.floor(F.datediff(_col(to_date), f) / 2).cast("int"))


def bisect_leaves(from_date, to_date, leaf_days: int = 1, max_days: int = 366) -> Column:
    """``[from, to)`` halved at ``bisect_mid``, and its halves again, until no piece
    is longer than ``leaf_days``: ``array<struct<from_date, to_date>>`` from left to
    right, the order of a recursion that finishes each left half first. All levels
    are built in one row, so no recursion limit applies; a range longer than
    ``max_days`` fails."""
    f, t = _col(from_date), _col(to_date)
    one = F.array(F.struct(f.alias("from_date"), t.alias("to_date")))
    levels = max(1, (max(1, max_days) - 1).bit_length())

    def halves(r: Column) -> Column:
        mid = bisect_mid(r["from_date"], r["to_date"])
        return F.when(F.datediff(r["to_date"], r["from_date"]) > max(1, int(leaf_days)), F.array(
            F.struct(r["from_date"].alias("from_date"), mid.alias("to_date")),
            F.struct(mid.alias("from_date"), r["to_date"].alias("to_date")))).otherwise(F.array(r))

    leaves = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), one, lambda acc, _: F.flatten(F.transform(acc, halves)))
    return F.when(F.datediff(t, f) <= max_days, leaves).otherwise(
        F.raise_error(F.lit(f"a range of more than {max_days} days cannot be halved to its end")))

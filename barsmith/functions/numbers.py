"""Number parsing of response cells.

Cells arrive as text (landed JSON) or as numbers. ``permissive`` turns a bad
cell into null; ``strict`` raises like the original job does.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


_INT_TEXT = r"^\s*[+-]?[0-9]{1,19}\s*$"
_EXACT = float(2 ** 53)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null_double(x) -> Column:
    """``""``, null and NaN -> null, else the number.

    Uses ``try_cast`` because a plain ``cast('')`` raises under ANSI mode, and
    maps NaN to null because Spark orders NaN above every number, which would
    corrupt later comparisons (moneyness).
    """
    parsed = F.nullif(_col(x).cast("string"), F.lit("")).try_cast("double")
    return F.when(F.isnan(parsed), F.lit(None).cast("double")).otherwise(parsed)


def to_double(x, strict: bool = False, what: str = "value") -> Column:
    """``float(x)`` (X13). Permissive: unparsable or missing -> null."""
    parsed = empty_to_null_double(x)
    if not strict:
        return parsed
    return F.when(parsed.isNull(), F.raise_error(F.lit(f"bad or missing {what}"))
                  ).otherwise(parsed)


def to_long(x, strict: bool = False, what: str = "value", parsed: Column | None = None) -> Column:
    """``int(x)`` on a JSON number or its text (X12): truncates toward zero.
    ``parsed`` is the cell as a double, where the caller has parsed it already.

    Integer text goes straight to bigint so large ids stay exact; anything else
    goes through double. NaN and overflow give null.
    """
    txt = F.nullif(_col(x).cast("string"), F.lit(""))
    dbl = txt.try_cast("double") if parsed is None else parsed
    # Below 2^53 a double holds every integer exactly, so truncating the
    # parsed double is exact and needs no second parse. Larger magnitudes
    # (and NaN / infinity) take the text path; only text that looks like an
    # integer is cast to bigint, because a failing try_cast from text is
    # about ten times slower than a passing one.
    as_int = F.when(txt.rlike(_INT_TEXT), txt.try_cast("bigint"))
    whole = F.when(F.abs(dbl) < F.lit(_EXACT), dbl.cast("bigint")).otherwise(
        F.coalesce(as_int, dbl.try_cast("bigint")))
    if not strict:
        return whole
    return F.when(whole.isNull(), F.raise_error(F.lit(f"bad or missing {what}"))
                  ).otherwise(whole)

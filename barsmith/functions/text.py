"""Text helpers for the instrument master."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Unicode-aware whitespace at either end (Python ``str.strip`` semantics;
# Spark's ``trim`` strips spaces only, so a tab would survive it).
_EDGE_WS = r"(?U)^\s+|\s+$"


def strip_ws(c) -> Column:
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def first_non_empty(*cols, default: str | None = "") -> Column:
    """``row.get(a) or row.get(b) or default``: empty text counts as missing."""
    parts = [F.nullif(_col(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def combined_text(symbol, display) -> Column:
    """``f"{symbol} {display}".strip()`` (P10)."""
    return strip_ws(F.concat(_col(symbol), F.lit(" "), _col(display)))


def matches_keywords(text, includes, excludes) -> Column:
    """Case-insensitive substring test (F4): any include (an empty include list
    passes) and no exclude."""
    up = F.upper(_col(text))
    inc = _col(includes)
    exc = _col(excludes)
    hit = F.exists(inc, lambda k: F.contains(up, F.upper(k)))
    miss = ~F.exists(exc, lambda k: F.contains(up, F.upper(k)))
    return ((F.size(inc) == 0) | hit) & miss

"""Epoch / IST helpers.

IST is the fixed +05:30 offset. Wall-clock values are built as
TIMESTAMP_NTZ by adding seconds to the NTZ epoch, which needs no session time
zone, so results are the same in any ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from barsmith.config import IST_OFFSET_SECONDS, IST_SUFFIX

_NTZ_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a timestamp; an NTZ value is read as UTC."""
    return F.unix_timestamp(_col(ts))


def ist_wall_time(epoch) -> Column:
    """IST wall-clock time of epoch seconds, as TIMESTAMP_NTZ."""
    return F.timestamp_add("SECOND", _col(epoch) + F.lit(IST_OFFSET_SECONDS),
                           F.expr(_NTZ_EPOCH))


def epoch_to_ist_iso(epoch) -> Column:
    """``yyyy-MM-ddTHH:mm:ss+05:30`` for epoch seconds."""
    return F.concat(F.date_format(ist_wall_time(epoch), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit(IST_SUFFIX))


def epoch_to_ist_date(epoch) -> Column:
    """IST calendar day of epoch seconds (X2, the resume day)."""
    return F.to_date(ist_wall_time(epoch))


def as_of_date(as_of: _dt.date | str | None = None) -> Column:
    """The job's 'today' (X16): a fixed parameter for repeatable runs, else
    today's IST date."""
    if as_of is None:
        return epoch_to_ist_date(F.unix_timestamp(F.current_timestamp()))
    return F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(as_of))


def candle_window_text(from_date, to_date) -> tuple[Column, Column]:
    """Candle request bounds: whole days, end day included."""
    return (F.concat(_col(from_date).cast("string"), F.lit(" 00:00:00")),
            F.concat(_col(to_date).cast("string"), F.lit(" 23:59:59")))


def option_window_text(from_date, to_date) -> tuple[Column, Column]:
    """Option request bounds: plain dates."""
    return _col(from_date).cast("string"), _col(to_date).cast("string")

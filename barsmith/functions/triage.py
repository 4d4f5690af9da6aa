"""Response classification."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barsmith.config import NO_DATA_ERROR_CODES, NO_DATA_TEXT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_response(status, error_code, error_message, days, corrupt=None,
                      n_rows=None) -> Column:
    """``ok``, ``empty`` (ok without timestamps, when ``n_rows`` is given),
    ``no_data`` (DH-905/DH-907 saying "no data"), ``split`` (HTTP 400 on a
    window longer than one day), ``corrupt`` (unreadable body) or ``fail``."""
    st, code, msg = _col(status), _col(error_code), _col(error_message)
    no_data = code.isin(*NO_DATA_ERROR_CODES) & F.contains(
        F.lower(F.coalesce(msg, F.lit(""))), F.lit(NO_DATA_TEXT))
    out = F.when(no_data, F.lit("no_data"))
    if corrupt is not None:
        out = out.when(_col(corrupt).isNotNull(), F.lit("corrupt"))
    ok = F.coalesce(st, F.lit(200)).between(200, 299) & code.isNull()
    if n_rows is not None:
        out = out.when(ok & (F.coalesce(_col(n_rows), F.lit(0)) == 0), F.lit("empty"))
    return (out.when(ok, F.lit("ok"))
            .when((st == 400) & (_col(days) > 1), F.lit("split"))
            .otherwise(F.lit("fail")))

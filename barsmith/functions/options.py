"""Option enrichment expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def atm_strike(spot, step) -> Column:
    """Spot rounded to the nearest strike step, ties to even.

    ``rint`` is half-even like Python's ``round``; SQL ``round`` is half-up.
    Cast to bigint before multiplying so no ``-0.0`` can appear (N7).
    """
    return F.rint(_col(spot) / _col(step)).cast("bigint") * _col(step).cast("bigint")


def moneyness(option_type, strike, spot, atm) -> Column:
    """ATM when strike is within 0.01 of the ATM strike; calls are ITM below
    spot, everything else ITM above spot; strike == spot is OTM (X4)."""
    k, s = _col(strike), _col(spot)
    return (F.when(F.abs(k - _col(atm)) < F.lit(0.01), F.lit("ATM"))
            .when(_col(option_type) == F.lit("CE"),
                  F.when(k < s, F.lit("ITM")).otherwise(F.lit("OTM")))
            .otherwise(F.when(k > s, F.lit("ITM")).otherwise(F.lit("OTM"))))


def guarded_moneyness(option_type, strike, spot, atm) -> Column:
    """Empty string unless strike, spot and ATM are all known."""
    ok = _col(strike).isNotNull() & _col(spot).isNotNull() & _col(atm).isNotNull()
    return F.when(ok, moneyness(option_type, strike, spot, atm)).otherwise(F.lit(""))


def stored_atm(atm) -> Column:
    """Stored ATM column: a zero ATM is stored as null."""
    return F.nullif(_col(atm), F.lit(0)).cast("double")


def strike_offset(bucket) -> Column:
    """``ATM`` -> 0, ``ATM+3`` -> 3, ``ATM-7`` -> -7 (X7); bad labels raise."""
    b = _col(bucket)
    return (F.when(b == F.lit("ATM"), F.lit(0))
            .otherwise(F.replace(b, F.lit("ATM"), F.lit("")).cast("int"))).cast("tinyint")

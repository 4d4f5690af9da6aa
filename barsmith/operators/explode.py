"""Column-array responses -> one row per candle.

A response row holds parallel arrays (``timestamp``, ``open``, ...). The arrays,
missing ones taken as empty, are zipped and exploded with their position, and
the cells are parsed after the explode, so generation and parsing run in one
code-generated stage. ``arrays_zip`` pads to the longest array: positions beyond
the timestamps are dropped, and each array's own size, carried along, tells a
cell beyond its end from a null inside it.

Three length policies, kept apart on purpose:

* ``strict`` (spot): open/high/low/close must have exactly as many values as
  timestamps, else the job fails; short volume is padded with 0.
* ``zero_fill`` (stocks): missing trailing prices are 0.0, volume 0.
* ``null_fill`` (options): missing trailing prices, iv, strike and spot are
  null; volume and oi 0.

Out-of-range and in-range-null cells are separate cases: a null *inside* an
array is null (prices) or 0 (volume, oi) when ``strict_cells`` is off, and
fails the job when it is on. Null and empty timestamp arrays give no rows.

Cells may be text or VARIANT; the arrays' type says which, and so how they are
parsed.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from barsmith.functions.numbers import empty_to_null_double, to_double, to_long
from barsmith.functions.variants import variant_double, variant_empty_to_null, variant_long

PRICE_FIELDS = ["open", "high", "low", "close"]


class Parsers(NamedTuple):
    """How the cells of a response are read."""
    to_long: Callable
    to_double: Callable
    empty_to_null: Callable


TEXT = Parsers(to_long, to_double, empty_to_null_double)
VARIANT = Parsers(variant_long, variant_double, variant_empty_to_null)


def cell_parsers(array: T.ArrayType) -> Parsers:
    return VARIANT if isinstance(array.elementType, T.VariantType) else TEXT


def _zipped(resp: DataFrame, carry: list[str], arrays: dict[str, Column]) -> DataFrame:
    """``carry``, ``pos``, the size of every array (``_n_<name>``) and its cell
    (``_c.<name>``), one row per timestamp."""
    named = resp.select(*carry, *[a.alias(f"_a_{n}") for n, a in arrays.items()])
    zipped = named.select(*carry, *[F.size(f"_a_{n}").alias(f"_n_{n}") for n in arrays],
                          F.arrays_zip(*[f"_a_{n}" for n in arrays]).alias("_z"))
    return zipped.select(*carry, *[f"_n_{n}" for n in arrays], F.posexplode("_z").alias("pos", "_c")) \
        .where(F.col("pos") < F.col("_n_timestamp"))


def _dtype(df: DataFrame, name: str, base: str | None) -> T.ArrayType:
    return df.schema[base].dataType[name].dataType if base else df.schema[name].dataType


def _arr(df: DataFrame, name: str, base: str | None) -> Column:
    """A response array, missing/null -> empty (``data.get(x) or []``)."""
    ref = F.col(f"{base}.{name}") if base else F.col(name)
    return F.coalesce(ref, F.array().cast(_dtype(df, name, base)))


def _cell(name: str) -> Column:
    return F.col(f"_c._a_{name}")


def _in_range(name: str) -> Column:
    return F.col("pos") < F.col(f"_n_{name}")


def _price(name: str, policy: str, strict_cells: bool, parse: Parsers) -> Column:
    value = parse.to_double(_cell(name), strict=strict_cells, what=name)
    if policy == "zero_fill":
        return F.when(_in_range(name), value).otherwise(F.lit(0.0))
    if policy == "null_fill":
        return F.when(_in_range(name), value)
    return value  # strict: lengths were checked per response


def _count(name: str, strict_cells: bool, parse: Parsers) -> Column:
    """volume / oi: 0 beyond the array; an in-range bad cell is 0 (or fails)."""
    value = parse.to_long(_cell(name), strict=strict_cells, what=name)
    if not strict_cells:
        value = F.coalesce(value, F.lit(0).cast("bigint"))
    return F.when(_in_range(name), value).otherwise(F.lit(0).cast("bigint"))


def explode_candles(resp: DataFrame, policy: str, carry: list[str],
                    base: str | None = None, strict_cells: bool = False,
                    label: Column | None = None) -> DataFrame:
    """Intraday response rows -> candle rows ``carry + pos, ts, open..close, volume``.

    ``base`` names a struct column holding the arrays (else top-level columns).
    """
    if policy not in ("strict", "zero_fill", "null_fill"):
        raise ValueError(policy)
    arrays = {n: _arr(resp, n, base) for n in ["timestamp", *PRICE_FIELDS, "volume"]}
    if policy == "strict":
        ts = arrays["timestamp"]
        n = F.size(ts)
        aligned = F.lit(True)
        for name in PRICE_FIELDS:
            aligned = aligned & (F.size(arrays[name]) == n)
        msg = F.concat(F.lit("Misaligned arrays in response "),
                       (label if label is not None else F.lit("?")).cast("string"))
        arrays["timestamp"] = F.when((n == 0) | aligned, ts).otherwise(F.raise_error(msg))
    parse = cell_parsers(_dtype(resp, "timestamp", base))
    return _zipped(resp, carry, arrays).select(
        *carry, "pos", parse.to_long(_cell("timestamp"), strict=strict_cells, what="timestamp").alias("ts"),
        *[_price(name, policy, strict_cells, parse).alias(name) for name in PRICE_FIELDS],
        _count("volume", strict_cells, parse).alias("volume"))


def select_side(data: Column, side: Column) -> Column:
    """CALL -> ``data.ce``, PUT -> ``data.pe`` (P5)."""
    return F.when(side == F.lit("CALL"), data.getField("ce")).otherwise(data.getField("pe"))


def explode_option_side(resp: DataFrame, side_col: str, carry: list[str],
                        strict_cells: bool = False) -> DataFrame:
    """Option response rows (one side struct each) -> one row per candle with
    the null-fill policy (P3). Strike and spot tolerate null, ``""`` and NaN
    (null); prices and iv are null beyond their arrays; volume and oi 0."""
    names = ["timestamp", *PRICE_FIELDS, "iv", "strike", "spot", "volume", "oi"]
    arrays = {n: _arr(resp, n, side_col) for n in names}
    parse = cell_parsers(_dtype(resp, "timestamp", side_col))
    return _zipped(resp, carry, arrays).select(
        *carry, "pos", parse.to_long(_cell("timestamp"), strict=strict_cells, what="timestamp").alias("ts"),
        parse.empty_to_null(_cell("strike")).alias("strike"),
        parse.empty_to_null(_cell("spot")).alias("spot"),
        *[_price(n, "null_fill", strict_cells, parse).alias(n) for n in [*PRICE_FIELDS, "iv"]],
        *[_count(n, strict_cells, parse).alias(n) for n in ("volume", "oi")])

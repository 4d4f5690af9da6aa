"""Response cells that keep their JSON type.

Text cells cannot tell the number ``1.9`` from the text ``"1.9"``; the original
truncates the first to 1 and fails on the second. Cells read as VARIANT keep
the difference:

==================  ==========================  =========================
cell                as integer                  as double
==================  ==========================  =========================
number              truncated toward zero       itself
``true, false``     1, 0                        1.0, 0.0
integer text        that integer                that number
other numeric text  bad                         that number
other text, ``""``  bad                         bad
null, array, object bad                         bad
NaN                 bad                         null
==================  ==========================  =========================

A bad cell is null, or fails the job with ``strict``. Whole numbers beyond 64
bits are bad as integers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barsmith.functions.numbers import _col

_NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _get(x, dtype: str) -> Column:
    return F.try_variant_get(_col(x), "$", dtype)


def variant_kind(x) -> Column:
    """``number``, ``text``, ``boolean``, ``null``, ``array`` or ``object``; null
    where there is no cell."""
    kind = F.schema_of_variant(_col(x))
    return (F.when(kind == "STRING", F.lit("text")).when(kind == "VOID", F.lit("null"))
            .when(kind == "BOOLEAN", F.lit("boolean")).when(kind.startswith("ARRAY"), F.lit("array"))
            .when(kind.startswith("OBJECT"), F.lit("object")).when(kind.isNotNull(), F.lit("number")))


def _checked(value: Column, strict: bool, what: str) -> Column:
    if not strict:
        return value
    return F.when(value.isNull(), F.raise_error(F.lit(f"bad or missing {what}"))).otherwise(value)


def variant_long(x, strict: bool = False, what: str = "value") -> Column:
    """``int(x)`` of a JSON cell."""
    # A decimal goes through double, as the original's parser reads it.
    decimal = F.schema_of_variant(_col(x)).startswith("DECIMAL")
    return _checked(F.when(decimal, _get(x, "double").try_cast("bigint")).otherwise(_get(x, "bigint")), strict, what)


def variant_empty_to_null(x) -> Column:
    """The cell as a double; null for ``""``, null, NaN and what is no number
    (P11, N6). Text has to look like a number: the cast alone takes ``1d``."""
    text = (F.schema_of_variant(_col(x)) == "STRING") & ~_get(x, "string").rlike(_NUMBER_TEXT)
    value = F.when(~F.coalesce(text, F.lit(False)), _get(x, "double"))
    return F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value)


def variant_double(x, strict: bool = False, what: str = "value") -> Column:
    """``float(x)`` of a JSON cell."""
    return _checked(variant_empty_to_null(x), strict, what)

"""Type enforcement against a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def cast_to_schema(df: DataFrame, schema: StructType, zero_fill: tuple[str, ...] = (),
                   extra: tuple[str, ...] = ()) -> DataFrame:
    """Select ``schema``'s columns cast to its types. Columns in ``zero_fill``
    get 0 for null (``fillna(0)``). Narrowing casts follow ANSI mode: an
    out-of-range value fails the job instead of wrapping."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in zero_fill:
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols, *extra)

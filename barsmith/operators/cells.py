"""What kinds of cells landed answers hold.

A report for answers read with variant cells: how many cells of each field are
numbers, text, empty text, booleans, nulls or nested values, and how many of
them a numeric field cannot take, before a strict run fails on the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from barsmith.functions.variants import variant_double, variant_kind, variant_long

#: Fields whose cells are integers; the others are doubles.
INTEGER_FIELDS = ("timestamp", "volume", "oi")


def cell_fields(schema: T.StructType) -> list[str]:
    """Paths of the fields of variant cells."""
    found = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            found += [f"{f.name}.{path}" for path in cell_fields(f.dataType)]
        elif f.dataType == T.ArrayType(T.VariantType()):
            found.append(f.name)
    return found


def cell_kinds(responses: DataFrame) -> DataFrame:
    """``field, kind, n_cells, n_bad`` of all cells of landed answers: ``kind`` is
    that of ``variant_kind``, and ``empty`` for ``""``; ``n_bad`` counts cells
    that are not a number of the field's type (NaN included). Fields and kinds without a cell have no
    row. Counts are partial sums: a row per field and kind leaves a task."""
    fields = cell_fields(responses.schema)
    if not fields:
        raise ValueError("no variant cells")

    def described(path: str):
        parse = variant_long if path.split(".")[-1] in INTEGER_FIELDS else variant_double
        return lambda x: F.struct(F.lit(path).alias("field"), x.alias("x"), parse(x).isNull().alias("bad"))

    cells = F.flatten(F.array(*[
        F.transform(F.coalesce(F.col(p), F.array().cast("array<variant>")), described(p)) for p in fields]))
    kind = F.when((variant_kind("c.x") == "text") & (F.try_variant_get("c.x", "$", "string") == ""), F.lit("empty")) \
        .otherwise(variant_kind("c.x"))
    return responses.select(F.explode(cells).alias("c")) \
        .select("c.field", kind.alias("kind"), F.col("c.bad").alias("bad")) \
        .groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("bad").alias("n_bad"))

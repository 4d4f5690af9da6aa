"""Landed response sources.

Each landed JSON line is one response: an envelope (``request_id``,
``status``, ``errorCode``, ``errorMessage``) and the body. Cells are read as
text so one ``""`` cannot null a whole numeric array, or as VARIANT where their
JSON types matter (``functions.variants``); unreadable lines land in
``_corrupt_record`` instead of failing the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barsmith.functions.triage import classify_response
from barsmith.schemas import response_schema


def _reader(spark: SparkSession, schema):
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record"))


def with_landing(responses: DataFrame) -> DataFrame:
    """Adds when and in which file a line landed (batch and stream reads)."""
    return responses.select("*", F.col("_metadata.file_modification_time").alias("_landed_at"),
                            F.col("_metadata.file_path").alias("_landed_file"))


def read_intraday_responses(spark: SparkSession, path: str, cells: str = "text") -> DataFrame:
    return with_landing(_reader(spark, response_schema("stocks", cells)).json(path))


def read_option_responses(spark: SparkSession, path: str, cells: str = "text") -> DataFrame:
    return with_landing(_reader(spark, response_schema("options", cells)).json(path))


def rank_answers(responses: DataFrame) -> DataFrame:
    """Adds ``_usable`` (a good status) and ``_rank``: 1 for the answer that
    decides what became of a request -- a usable one if there is any, of these
    the one landed last, by file time, then file, then content -- and more for
    the others. Lines without a readable request id each stand alone."""
    landing = {"_landed_at": "timestamp", "_landed_file": "string"}
    usable = (F.coalesce("status", F.lit(200)).between(200, 299) & F.col("errorCode").isNull()
              & F.col("_corrupt_record").isNull() & F.col("request_id").isNotNull())
    have = responses.select("*", usable.alias("_usable"), *[F.lit(None).cast(t).alias(c) for c, t in landing.items()
                                   if c not in responses.columns])
    # Variants have no hash of their own.
    typed = {f.name: "variant" in f.dataType.simpleString() for f in responses.schema.fields}
    body = F.xxhash64(*[F.to_json(c) if typed[c] else F.col(f"`{c}`") for c in responses.columns if c not in landing])
    newest = Window.partitionBy("request_id").orderBy(
        F.col("_usable").desc(), F.col("_landed_at").desc_nulls_last(), F.col("_landed_file").desc_nulls_last(), body.desc())
    named = have.where(F.col("request_id").isNotNull()).withColumn("_rank", F.row_number().over(newest))
    lone = have.where(F.col("request_id").isNull()).withColumn("_rank", F.lit(1))
    return named.unionByName(lone)


def outcome_table(responses: DataFrame, manifest: DataFrame, sizes: dict[str, Column],
                  n_rows: Column, report_missing: bool = True,
                  n_bad_ts: Column | None = None) -> DataFrame:
    """One slim row per request -- and per landed line that matches no
    request -- with its outcome (R2, X17), without the response bodies.

    ``sizes`` are per-response array sizes computed before the join (e.g. the
    timestamp count of each option side); ``n_rows`` picks the size that
    counts after the join (it may depend on the request, e.g. its side).
    Outcomes: ok / empty / no_data / split / corrupt / fail, ``bad_ts`` for an
    answer with rows some of whose timestamps cannot be read (``n_bad_ts``
    counts them), ``missing`` for a request without a response and ``orphan``
    for a line without a request (unreadable JSON has no id). Batch runs join
    in full; a stream micro-batch starts from the responses it holds (no
    ``missing``)."""
    slim = responses.select(
        "request_id", "status", "errorCode", "errorMessage", "_corrupt_record",
        F.lit(True).alias("_has_response"), *[c.alias(n) for n, c in sizes.items()])
    req = manifest.withColumn("_has_request", F.lit(True))
    j = req.join(slim, "request_id", "full" if report_missing else "right")
    days = F.datediff("to_date", "from_date")
    outcome = (F.when(F.col("_has_request").isNull(), F.lit("orphan"))
               .when(F.col("_has_response").isNull(), F.lit("missing"))
               .otherwise(classify_response("status", "errorCode", "errorMessage", days,
                                            corrupt="_corrupt_record",
                                            n_rows=F.coalesce(n_rows, F.lit(0)))))
    bad = F.lit(0) if n_bad_ts is None else F.coalesce(n_bad_ts, F.lit(0))
    out = j.withColumn("outcome", outcome).withColumn("n_bad_ts", bad.cast("bigint"))
    out = out.withColumn("outcome", F.when((F.col("outcome") == "ok") & (F.col("n_bad_ts") > 0), F.lit("bad_ts"))
                         .otherwise(F.col("outcome")))
    return out.drop("_has_request", "_has_response", *sizes)

"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.llm import (
    decontaminate, extract, fertility, filteraudit, lexsearch, linespread, packing, resample,
    spotsigs, suffix_tree, toccurrence, toxicity, urlfilter)
from barsmith.llm.staging import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def remainder(doc_id, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as 0."""
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)), F.lit(n))


@query
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.resample(docs, read_table(spark, sf_dir, "labels"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "log_weight",
                        F.col("sum").alias("gumbel_sum"), "kept")


@query
def op2_distinct_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linespread.clean(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed")


ORACLE["op2_distinct_site_spread"] = linespread.ORACLE


@query
def op3_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"),
                         usable=remainder(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, *model).select(
        F.col("row.doc_id").alias("doc_id"),
        (remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged")


@query
def op4_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), crc32=True)


@query
def op6_t_occurrence_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toccurrence.jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_prefix_filtered_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.scan(docs, read_table(spark, sf_dir, "benchmark")))


ORACLE["op7_prefix_filtered_windows"] = decontaminate.ORACLE


@query
def op8_sorted_digest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    entries = urlfilter.entries_frame(spark, urlfilter.RULES + urlfilter.LISTED)
    return urlfilter.verdicts(urlfilter.judge(pages, entries))


ORACLE["op8_sorted_digest_array"] = urlfilter.ORACLE


@query
def op9_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fertility.judge(docs).select(
        F.col("row.doc_id").alias("doc_id"), *fertility.COUNTS, "entropy", "n_tokens_2", "entropy_2", "base_failed", "kept")


@query
def op10_probabilistic_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_tree.score(docs, remainder(F.col("doc_id"), 5) == 1)
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 1).alias("held_out"),
                        "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_recurrent_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages).select(
        F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text",
        F.length("text").cast("bigint").alias("n_chars"))


@query
def op11_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.edited_pairs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint("own").alias("fingerprint"), spotsigs.fingerprint("other").alias("edited_fingerprint"),
        "near_edited", "near_next")


ORACLE["op11_spot_signatures"] = spotsigs.ORACLE


@query
def op12_dense_blas_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexsearch.search(docs, read_table(spark, sf_dir, "benchmark"))


ORACLE["op12_dense_blas_tiles"] = lexsearch.ORACLE


@query
def op13_lehmer_rank_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filteraudit.audit(filteraudit.failures(docs, read_table(spark, sf_dir, "labels")))


ORACLE["op13_lehmer_rank_audit"] = filteraudit.ORACLE

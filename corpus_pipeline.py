"""The corpus pipeline: quality, line dedup, near duplicates, decontamination
and packing of ``documents``.

Every stage takes what its predecessor kept, all of it, and passes on the
columns of ``documents``; the last returns the pieces of the packed sequences.
Between stages the documents are written as Parquet under the shared folder
and read again, so a lost executor costs a stage at most.

Defined results: see the operators. Null texts have no n-grams, lines, shingles
or words and are kept by every stage; they pack as a lone end id. A row without
an id is never a near duplicate's representative and stays. An empty table gives
no rows. Columns beyond those of ``documents`` pass through up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith.llm import decontaminate, linespread, packing, resample, toccurrence
from barsmith.llm.staging import read_table, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that importance resampling rejects go."""
    return resample.keep(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines spread over many sites are cut out of the texts, but not of copies."""
    found = linespread.clean(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of every group of linked documents the smallest id stays."""
    return toccurrence.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the documents as pieces of 4096-token sequences."""
    return packing.pack(docs, crc32=True)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", pack)]

#: The first stage draws on hashed n-gram models and the last on a tokenizer,
#: which SQL cannot express; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

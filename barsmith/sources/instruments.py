"""Instrument master CSV source.

The master is read with a header and no schema inference (every cell is
text). Header names and cells are stripped of surrounding whitespace, tabs
included. Ties in resolution depend on the master's line order, which Spark
does not keep for CSV, so the master is landed once as Parquet with an
explicit ``row_seq``. Quoted cells may hold commas, doubled quotes and line
breaks, as a standard CSV reader takes them; a line break inside a cell needs the
file to be read whole, so a file is one split (the master is one small file, and
several files are read in parallel):

``row_seq`` = rows in earlier file splits + position inside the split. The
position comes from ``monotonically_increasing_id`` (consecutive inside one
task, and one split's rows are contiguous in a task); splits are ordered by
``(file path, block start)``, which is line order for files written in order.
The per-split table has one row per file split, so its (single-partition)
window is bounded by the number of splits, not by the number of rows; the
join back is left to AQE, which broadcasts it only when its measured size
is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barsmith.functions.text import strip_ws


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .option("escape", '"').option("multiLine", True)
           .csv(path))
    # Strip header names and cells (Unicode whitespace, like Python strip).
    return raw.select(*[strip_ws(F.col(f"`{c}`")).alias(c.strip()) for c in raw.columns],
                      F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"))


def with_line_order(df: DataFrame) -> DataFrame:
    """Add ``row_seq`` (0-based line order over all files) and drop the
    helper columns. Must be applied directly on the read (same partitioning
    on both uses)."""
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    splits = (tagged.groupBy("_file", "_block")
              .agg(F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # No broadcast hint: the split table grows with the number of file
    # splits, so AQE decides from its measured size at runtime.
    j = tagged.join(splits.select("_file", "_block", "_mid0", "_off"), ["_file", "_block"])
    seq = (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias("row_seq")
    keep = [c for c in df.columns if not c.startswith("_")]
    return j.select(seq, *keep)


def land_master(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Read the master CSV once, number its lines and land it as Parquet;
    later resolution reads only the landed table."""
    with_line_order(read_master_csv(spark, csv_path)).write.mode("overwrite") \
        .parquet(parquet_path)
    return spark.read.parquet(parquet_path)

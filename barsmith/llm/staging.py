"""Tables written under ``spark.checkpoint.dir`` and read again, and row keys."""

from __future__ import annotations

import ctypes
import math
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import barsmith
from barsmith.session import scratch_path
from barsmith.sources.store import remove_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage is
    cut, and a lost executor re-reads files in place of recomputing them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a table that ``staged`` wrote, once nothing lazy reads it."""
    if getattr(df, "_staged_path", None):
        remove_path(df.sparkSession, df._staged_path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column over all rows (one narrow aggregate)."""
    return docs.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


def pieces_for(total: int, each: int, least: int = 1) -> int:
    """How many pieces of about ``each`` make ``total``; grows with the input."""
    return max(least, math.ceil(total / each))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application,
    so that they need neither an installed copy nor the driver's folders."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(barsmith.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="barsmith-")) / "barsmith_workers.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


#: Bytes of one Arrow batch sent to a Python worker, however many rows fit.
BATCH_BYTES = 4 << 20


def _release() -> None:
    """Give memory that a finished task has freed back to the system: workers
    are reused, and what each keeps adds up on an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") != str(BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the workers, small batches,
    and memory released after each task."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            _release()

    _prepare(df.sparkSession)
    return df.mapInArrow(task, schema)


def arrow_groups(df: DataFrame, keys: list[str], run, schema) -> DataFrame:
    """``df.groupBy(keys).applyInArrow``, likewise."""
    def task(group):
        out = run(group)
        _release()
        return out

    _prepare(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(task, schema)

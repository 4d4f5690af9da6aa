"""Clustered files: range partitioned by day and entity, with an index.

Layout under the path::

    data/generation=00017…-6f0c1a2b/part-*.parquet    rows sorted by (day, entity, ts)
    _index/generation=00017…-6f0c1a2b/part-*.parquet  entity, day, file, ts range, rows
    _commits/part-*.parquet                           generations made and dropped

Rows go to files by ranges of (day, entity, ts) whose bounds Spark samples, so
files have about the same size whatever the days and entities hold: quiet days
share a file, a busy day has many, and an entity with a third of all rows is
split by time. There is no bucket count to choose, and none to outgrow.

The index has one row per file, day and entity -- one for the hundreds of candles
an entity has in a day -- and is itself sorted by entity. A read looks its
entities and times up there by an equi-join, and opens the files found; inside
them the statistics and Bloom filters of the sorted row groups skip the rest. Only
names of files to open reach the driver, as any list of input files does.

A write is a new generation, and one log file, whose appearance is the commit.
Readers take the newest one, and a write that stops half-way leaves them the old.

Null entities and times are stored, sorted first, and found by reads without a
condition on them. No rows make a generation without files.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from barsmith.sources.store import partition_column, path_exists, remove_path

#: Rows of a file: some 128 MB of candles.
ROWS_PER_FILE = 4_000_000
GENERATION = "generation"
LOG_SCHEMA = "generation string, dropped boolean"


@dataclass(frozen=True)
class ClusteredStore:
    """Rows of ``schema`` (with its day or month column) at ``path``, clustered by
    that column, ``entity`` and ``ts``."""

    spark: SparkSession
    path: str
    schema: StructType
    entity: str
    rows_per_file: int = ROWS_PER_FILE
    part: str = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "part", partition_column(self.schema))

    def _folder(self, kind: str, generation: str) -> str:
        return f"{self.path.rstrip('/')}/{kind}/{GENERATION}={generation}"

    @property
    def _log(self) -> str:
        return f"{self.path.rstrip('/')}/_commits"

    @property
    def _index_schema(self) -> StructType:
        return StructType([
            StructField(self.entity, StringType()), StructField(self.part, StringType()), StructField("file", StringType()),
            StructField("first_ts", LongType()), StructField("last_ts", LongType()), StructField("n_rows", LongType())])

    def generations(self) -> list[str]:
        """Names of the committed generations that were not dropped, oldest first."""
        if path_exists(self.spark, self._log) is False:
            return []
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self._log).collect()
        return sorted({r.generation for r in log} - {r.generation for r in log if r.dropped})

    def _commit(self, generations: list[str], dropped: bool) -> None:
        self.spark.createDataFrame([(g, dropped) for g in generations], LOG_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(self._log)

    # ------------------------------------------------------------ writing

    def write(self, rows: DataFrame) -> str:
        """A new generation with these rows; returns its name. ``rows`` are read
        three times (count, sample of the bounds, write): give stored rows."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        generation = f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:8]}"
        data, order = self._folder("data", generation), [self.part, self.entity, "ts"]
        n = rows.count()
        self._ranged(rows, n, order).option(f"parquet.bloom.filter.enabled#{self.entity}", "true").parquet(data)
        stored = self.spark.read.schema(self.schema).parquet(data)
        facts = stored.groupBy(self.entity, self.part, F.col("_metadata.file_path").alias("file")).agg(
            F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_rows"))
        # As many files as the rows have: no more index rows than rows.
        self._ranged(facts, n, [self.entity, self.part, "file"]).parquet(self._folder("_index", generation))
        self._commit([generation], dropped=False)
        return generation

    def _ranged(self, rows: DataFrame, n: int, order: list[str]):
        files = max(1, -(-n // self.rows_per_file))
        return rows.repartitionByRange(files, *order).sortWithinPartitions(*order) \
            .write.mode("error").option("compression", "snappy")

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` (1 at least) generations, and what
        stopped writes older than these left; returns how many committed ones went."""
        made = self.generations()
        old, kept = made[:-max(keep, 1)], made[-max(keep, 1):]
        if old:
            self._commit(old, dropped=True)
        if kept:
            jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
            glob = jvm.org.apache.hadoop.fs.Path(self._folder("*", "*"))
            for status in glob.getFileSystem(conf).globStatus(glob) or []:
                if status.getPath().getName().split("=", 1)[1] < kept[0]:
                    remove_path(self.spark, status.getPath().toString())
        return len(old)

    # ------------------------------------------------------------ reading

    def index(self) -> DataFrame:
        """Entity, day, file, ``first_ts``, ``last_ts`` and ``n_rows`` of the newest
        generation."""
        made = self.generations()
        if not made:
            return self.spark.createDataFrame([], self._index_schema)
        return self.spark.read.schema(self._index_schema).parquet(self._folder("_index", made[-1]))

    def _where(self, rows: DataFrame, entities: list[str] | DataFrame | None, first_ts: int | None, last_ts: int | None,
               low: str, high: str) -> DataFrame:
        if first_ts is not None:
            rows = rows.where(F.col(high) >= first_ts)
        if last_ts is not None:
            rows = rows.where(F.col(low) <= last_ts)
        if isinstance(entities, DataFrame):
            return rows.join(entities.select(self.entity), self.entity, "left_semi")
        return rows if entities is None else rows.where(F.col(self.entity).isin(list(entities)))

    def files(self, entities: list[str] | DataFrame | None = None, first_ts: int | None = None,
              last_ts: int | None = None) -> list[str]:
        """Files that hold rows of these entities (a short list, or a table with a
        column of that name) and whose times of them meet the given range."""
        found = self._where(self.index(), entities, first_ts, last_ts, "first_ts", "last_ts")
        return sorted(r[0] for r in found.select("file").distinct().collect())

    def read(self, entities: list[str] | DataFrame | None = None, first_ts: int | None = None,
             last_ts: int | None = None) -> DataFrame:
        """The rows of the newest generation, of some entities and times (both ends
        included). The list of files is fixed here."""
        files = self.files(entities, first_ts, last_ts)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*files)
        return self._where(rows, entities, first_ts, last_ts, "ts", "ts").select(*self.schema.names)

"""Store with a commit log: atomic, merge-on-read upserts.

Layout under the store's path::

    trade_date=2024-01-05/segment=00000012-6f0c1a2b/part-*.parquet   rows of commit 12
    _commits/part-*.parquet                                          one file per commit

An upsert writes its own rows as a new *segment* of every partition (day or
month) that it touches, and then one log file, whose appearance is the commit.
Readers take the segments that the log lists, so a run that stops half-way
leaves them the old state; its unlisted folders are cleared by ``vacuum``. Rows
that several segments of a partition hold for one key are merged when read:
newest by the store's order, and, where that ties, by ``landing``, the number of
the commit that brought the row. A partition whose segments would exceed
``max_segments`` is rewritten as one in the same commit.

The log is a table of facts -- segments added and dropped, the largest ``ts`` per
entity, the last micro-batch of a stream -- whose meaning does not depend on the
order or repetition of its rows. The high watermark is an aggregate of the log
alone. One writer per store at a time decides the landing order; two at once lose
no rows, as a rewrite drops only the segments it has read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from barsmith.operators.dedupe import keep_last, keep_last_by_partition
from barsmith.operators.summary import incoming_counts
from barsmith.session import scratch_path
from barsmith.sources.store import partition_column, partition_rows, path_exists, read_store, remove_path, stage_batch

LOG, SEGMENT, LANDING = "_commits", "segment", "landing"
#: Segments of one partition before it is rewritten as one.
MAX_SEGMENTS = 8
#: Log files before they are written anew as one.
MAX_LOG_FILES = 64

LOG_SCHEMA = StructType([
    StructField("seq", LongType()),        # number of the commit
    StructField("action", StringType()),   # add, drop, seen, batch
    StructField("part", StringType()),     # add, drop: the partition value
    StructField("segment", StringType()),  # add, drop: the segment's folder
    StructField("name", StringType()),     # seen: the entity; batch: the stream
    StructField("value", LongType()),      # seen: largest ts; batch: the epoch
])


@dataclass(frozen=True)
class CommitStore:
    """A store of ``schema`` (with its partition column and ordering columns) at
    ``path``; ``entity`` is the column whose ``max(ts)`` the log keeps."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: list[str]
    order: list[str]
    sort_cols: list[str]
    entity: str
    max_segments: int = MAX_SEGMENTS
    part: str = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "part", partition_column(self.schema))

    # ------------------------------------------------------------ the log

    @property
    def log_path(self) -> str:
        return f"{self.path.rstrip('/')}/{LOG}"

    def exists(self) -> bool:
        return path_exists(self.spark, self.log_path) is not False

    def log(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def segments(self) -> DataFrame:
        """``part, segment`` of the live segments."""
        log = self.log()
        gone = log.where("action = 'drop'").select("part", SEGMENT)
        return log.where("action = 'add'").select("part", SEGMENT).distinct() \
            .join(gone, ["part", SEGMENT], "left_anti")

    def watermarks(self) -> DataFrame:
        """Entity and ``last_ts``, its largest stored ``ts``, from the log alone
        (from the rows, where the store was written without a log)."""
        if not self.exists():
            rows = read_store(self.spark, self.path, self.schema)
            return rows.groupBy(self.entity).agg(F.max("ts").alias("last_ts"))
        return self.log().where("action = 'seen'").groupBy(F.col("name").alias(self.entity)) \
            .agg(F.max("value").alias("last_ts"))

    def _state(self) -> tuple[int, dict[str, list[str]], dict[str, int]]:
        """From one pass over the log: the last commit's number, the live segments
        by partition, and the last micro-batch of every stream. Brings a name per
        segment to the driver, as a reader's list of folders needs."""
        seq, added, gone, batches = 0, set(), set(), {}
        for r in self.log().where("action <> 'seen'").collect():
            seq = max(seq, r.seq)
            if r.action == "batch":
                batches[r.name] = max(r.value, batches.get(r.name, r.value))
            else:
                (added if r.action == "add" else gone).add((r.part, r.segment))
        live: dict[str, list[str]] = {}
        for part, segment in sorted(added - gone):
            live.setdefault(part, []).append(segment)
        return seq, live, batches

    def last_batch(self, stream: str) -> int | None:
        """The last committed micro-batch of a stream."""
        return self._state()[2].get(stream)

    def _commit(self, rows: DataFrame) -> None:
        """One file, moved into place when it is whole: the commit."""
        rows.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA.fields]) \
            .coalesce(1).write.mode("append").parquet(self.log_path)

    # ------------------------------------------------------------ reading

    def _folders(self, live: list[tuple[str, str]]) -> DataFrame:
        """The rows of given segments, with their landing."""
        names = [f for f in self.schema.fields if f.name != self.part]
        schema = StructType([*names, StructField(LANDING, LongType()), self.schema[self.part]])
        root = self.path.rstrip("/")
        if not live:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(
            *[f"{root}/{self.part}={p}/{SEGMENT}={s}" for p, s in live])
        return rows.select(*self.schema.names, LANDING)

    def _merged(self, parts: list[str] | None = None, landing: bool = False) -> DataFrame:
        live = self._state()[1]
        if parts is not None:
            live = {p: live[p] for p in parts if p in live}
        # One segment has one row per key; only the others are merged.
        lone = [(p, v[0]) for p, v in live.items() if len(v) == 1]
        many = [(p, s) for p, v in live.items() if len(v) > 1 for s in v]
        rows = self._folders(lone)
        if many:
            newest = keep_last(self._folders(many), [self.part, *self.keys], [*self.order, LANDING])
            rows = newest if not lone else rows.unionByName(newest)
        return rows if landing else rows.drop(LANDING)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The stored rows as of now (the list of files is fixed here), of all
        partitions or of some."""
        if not self.exists():
            rows = read_store(self.spark, self.path, self.schema)
            return rows if parts is None else rows.where(F.col(self.part).isin(parts))
        return self._merged(parts)

    # ------------------------------------------------------------ writing

    def upsert(self, batch: DataFrame, stream: str | None = None, epoch: int | None = None,
               metrics: dict | None = None, reports: dict | None = None, stage: bool = True) -> list[str]:
        """Commit a batch; returns the partitions it touched. Rows are shuffled once,
        by partition (``keep_last_by_partition``). ``stage=False`` reads the batch
        several times instead of staging it, for one that is a plain reading of
        files and gives the same rows each time. An empty batch
        commits nothing (F7), nor does a micro-batch that was committed before.
        ``metrics`` gets ``rows_in``, ``rows_written`` (to files, rewrites
        included), ``n_partitions`` and ``n_rewritten``; ``reports`` the
        per-entity run summary (R6), staged."""
        spark, col = self.spark, self.part
        if not self.exists() and path_exists(spark, self.path):
            raise ValueError(f"{self.path} holds a store without a commit log")
        last, live, batches = self._state()
        if stream is not None and epoch <= batches.get(stream, -1):
            return []
        batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if stage:
            staged, sizes, stage_path = stage_batch(spark, batch, self.schema)
        else:
            staged, sizes, stage_path = batch, partition_rows(batch, col), None
        parts = sorted(sizes)
        if not parts:
            if stage_path:
                remove_path(spark, stage_path)
            return []
        seq = last + 1
        name = f"{seq:08d}-{uuid.uuid4().hex[:8]}"
        full = [p for p in parts if len(live.get(p, [])) >= self.max_segments]
        read = [(p, s) for p in full for s in live[p]]
        if reports is not None:
            self._summarize(staged, parts, reports)
        obs_in, obs_out = Observation("rows_in"), Observation("rows_written")
        new = staged.observe(obs_in, F.count(F.lit(1)).alias("rows_in")).withColumn(
            LANDING, F.lit(seq).cast("bigint"))
        if full:
            old = self._folders(read)
            for p, n in partition_rows(old, col).items():
                sizes[p] = sizes.get(p, 0) + n
            new = new.unionByName(old)
        # Rows of one landing that tie are alike in all of the order.
        new = keep_last_by_partition(new, col, self.keys, [*self.order, LANDING], sizes)
        new = new.observe(obs_out, F.count(F.lit(1)).alias("rows_written"))
        (new.withColumn(SEGMENT, F.lit(name))
            .sortWithinPartitions(col, *self.sort_cols)
            .write.mode("append").option("compression", "snappy").partitionBy(col, SEGMENT).parquet(self.path))
        self._commit(self._facts(staged, read, seq, name, stream, epoch))
        if stage_path:
            remove_path(spark, stage_path)
        if metrics is not None:
            metrics.update(obs_in.get)
            metrics.update(obs_out.get)
            metrics.update(n_partitions=len(parts), n_rewritten=len(full))
        self.compact_log(MAX_LOG_FILES)
        return parts

    def _facts(self, staged: DataFrame, read: list[tuple[str, str]], seq: int, name: str, stream: str | None,
               epoch: int | None) -> DataFrame:
        """The log rows of a commit: bounded by its partitions and entities."""
        none, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

        def fact(rows: DataFrame, action: str, part=none, segment=none, name=none, value=number):
            return rows.select(F.lit(seq).alias("seq"), F.lit(action).alias("action"), part.alias("part"),
                               segment.alias("segment"), name.cast("string").alias("name"), value.alias("value"))

        facts = fact(staged.select(self.part).distinct(), "add", F.col(self.part), F.lit(name))
        seen = staged.groupBy(self.entity).agg(F.max("ts").alias("_ts"))
        facts = facts.unionByName(fact(seen, "seen", name=F.col(self.entity), value=F.col("_ts")))
        if read:  # what a rewrite has read, and nothing else
            old = self.segments().where(F.concat_ws("/", "part", SEGMENT).isin([f"{p}/{s}" for p, s in read]))
            facts = facts.unionByName(fact(old, "drop", F.col("part"), F.col(SEGMENT)))
        if stream is not None:
            facts = facts.unionByName(fact(self.spark.range(1), "batch", name=F.lit(stream),
                                           value=F.lit(epoch).cast("bigint")))
        return facts

    def _summarize(self, staged: DataFrame, parts: list[str], reports: dict) -> None:
        """Rows in, keys new and replaced, and rows owned afterwards, per entity,
        against the stored keys of the touched partitions."""
        existing = self.read(parts).select(*dict.fromkeys([self.entity, *self.keys]))
        held = existing.groupBy(self.entity).agg(F.count(F.lit(1)).alias("_held"))
        counts = incoming_counts(existing, staged, self.entity, self.keys).join(held, self.entity, "full")
        zero = F.lit(0).cast("bigint")
        summary = counts.select(
            self.entity, *[F.coalesce(c, zero).alias(c) for c in ("rows_in", "keys_new", "keys_replaced")],
            (F.coalesce("_held", zero) + F.coalesce("keys_new", zero)).alias("rows_out"))
        path = scratch_path(self.spark, "run-summary")
        summary.write.mode("overwrite").parquet(path)
        reports["entity_summary"] = self.spark.read.parquet(path)
        reports.setdefault("scratch", []).append(path)

    # ------------------------------------------------------------ upkeep

    def compact_log(self, more_than: int = 1) -> bool:
        """Write the log anew as one file, where it has more than ``more_than``.
        Until the old files are gone both are read, which changes nothing. A
        dropped segment stays listed as dropped as long as a file lists it as
        added, so that removing the old files one by one brings none back."""
        log = self.log()
        files = log.inputFiles()
        if len(files) <= more_than:
            return False
        added = log.where("action = 'add'").select("part", SEGMENT)
        keep = log.where("action = 'add'").join(self.segments(), ["part", SEGMENT], "left_semi") \
            .unionByName(log.where("action = 'drop'").join(added, ["part", SEGMENT], "left_semi")) \
            .select(*LOG_SCHEMA.names).distinct()
        best = log.where("action IN ('seen', 'batch')").groupBy("action", "name").agg(
            F.max("value").alias("value"), F.max("seq").alias("seq")) \
            .withColumns({"part": F.lit(None).cast("string"), SEGMENT: F.lit(None).cast("string")})
        self._commit(keep.unionByName(best))
        for f in files:
            remove_path(self.spark, f)
        return True

    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders of segments that are not live and belong to none of
        the last ``keep`` commits, whose readers may still hold them; returns how
        many. Clears what stopped runs have left, once later ones committed."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        live = {(r.part, r.segment) for r in self.segments().collect()}
        last = self._state()[0] - keep
        glob = jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{self.part}=*/{SEGMENT}=*")
        gone = 0
        for status in glob.getFileSystem(conf).globStatus(glob) or []:
            folder = status.getPath()
            part, segment = (folder.getParent().getName().split("=", 1)[1], folder.getName().split("=", 1)[1])
            if (part, segment) not in live and int(segment.split("-")[0]) <= last:
                gone += remove_path(self.spark, folder.toString())
        return gone

"""Reading and migrating datasets in the original per-entity file layout
(S7, S8).

The original job stores one Parquet file per entity and keeps the entity only
in the path:

* spot: ``<root>/spot/<short>/<SHORT>_1m.parquet``
* options: ``<root>/options/<short>/<NAME>_OPTIONS_1m.parquet``
* stocks: ``<root>/stocks/<SYMBOL>/<SYMBOL>_1m.parquet``

All files of a kind are read in one scan (a glob, no loop per file) and the
entity is recovered from ``_metadata.file_path``. ``migrate`` upserts them
into the partitioned store with ingest run 0, so any later run wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from barsmith.schemas import CANDLE, OPTION_CANDLE
from barsmith.session import shuffle_width
from barsmith.sources.commit_log import CommitStore
from barsmith.sources.store import partition_column, partition_value

# File layout of the original job (fixed values).
LEGACY_GLOBS = {
    "spot": "spot/*/*_1m.parquet",
    "stocks": "stocks/*/*_1m.parquet",
    "options": "options/*/*_OPTIONS_1m.parquet",
}
LEGACY_ENTITY = {
    "spot": r"/spot/[^/]+/([^/]+)_1m\.parquet$",
    "stocks": r"/stocks/([^/]+)/[^/]+_1m\.parquet$",
    "options": r"/options/[^/]+/([^/]+)_OPTIONS_1m\.parquet$",
}


#: Folders of the original layout that are filled at the same time.
RENAMES = 16


def _file_schema(kind: str) -> T.StructType:
    base = OPTION_CANDLE if kind == "options" else CANDLE
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in base.fields
                         if f.name != "symbol"])


def read_legacy(spark: SparkSession, root: str, kind: str,
                path_glob: str | None = None, entity_pattern: str | None = None) -> DataFrame:
    """All entity files of one kind as one DataFrame with the consumer schema;
    ``symbol`` (candles) comes from the path."""
    glob = path_glob or f"{root.rstrip('/')}/{LEGACY_GLOBS[kind]}"
    pattern = entity_pattern or LEGACY_ENTITY[kind]
    df = (spark.read.schema(_file_schema(kind)).option("recursiveFileLookup", False)
          .parquet(glob))
    entity = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    if kind == "options":
        return df.select(*[F.col(f.name).cast(f.dataType) for f in OPTION_CANDLE.fields])
    return df.select(entity.alias("symbol"),
                     *[F.col(f.name).cast(f.dataType) for f in CANDLE.fields if f.name != "symbol"])


def to_legacy_layout(spark: SparkSession, written: str | DataFrame, column: str, target: str) -> int:
    """Puts a dataset into the per-entity names: ``<target>/<E>/<E>_1m.parquet``
    (``<E>-<n>_1m.parquet`` for further files of an entity), ``<E>`` being ``column``
    as a partition folder spells it; returns the number of files.

    ``written`` is a dataset partitioned by ``column``, whose files are renamed, or the
    rows themselves. Under a local or mounted ``target`` the tasks write rows into the
    files straight away; elsewhere they take a partitioned write and its renames."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(conf)
    if isinstance(written, DataFrame):
        if fs.getScheme() == "file":
            return _write_entities(written, column, path(target).toUri().getPath())
        rows, written = written, f"{target.rstrip('/')}-written"
        rows.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(written)

    def entity_files(folder: str) -> int:
        entity = folder.rsplit("/", 1)[1].split("=", 1)[1]
        fs.mkdirs(path(f"{target}/{entity}"))
        parts = fs.globStatus(path(f"{folder}/*.parquet"))
        for n, part in enumerate(parts):
            suffix = f"-{n}" if n else ""
            fs.rename(part.getPath(), path(f"{target}/{entity}/{entity}{suffix}_1m.parquet"))
        return len(parts)

    # Each call waits for the file system: many at a time, as an entity is its own folder.
    folders = [f.getPath().toString() for f in fs.globStatus(path(f"{written}/{column}=*"))]
    with ThreadPoolExecutor(RENAMES) as pool:
        return sum(pool.map(entity_files, folders))


#: Rows of one file of an entity, of one writing task, and of one row group.
FILE_ROWS, TASK_ROWS, GROUP_ROWS = 4_000_000, 1_000_000, 250_000
#: What a partitioned write calls the folder of null and the empty text.
NO_ENTITY = "__HIVE_DEFAULT_PARTITION__"


def _write_entities(rows: DataFrame, column: str, folder: str) -> int:
    """Every entity's rows in one task and one file; one of more than ``FILE_ROWS`` is
    dealt over several. A task has its entities one after the other and holds a row
    group at most. Files get their name when they are whole, so a task may run twice."""
    spark = rows.sparkSession
    own = F.col(f"`{column}`").cast("string")
    rows = rows.withColumn(column, F.when(own != "", own).otherwise(F.lit(NO_ENTITY)))
    large = F.col("n") > FILE_ROWS
    found = rows.groupBy(F.col(f"`{column}`").alias("_own")).agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("n"), F.collect_list(F.when(large, F.struct("_own", F.ceil(F.col("n") / FILE_ROWS))))).first()
    piece: Column = F.lit(0)
    if found[1]:
        deal = F.broadcast(spark.createDataFrame([tuple(x) for x in found[1]], "_own string, _pieces bigint"))
        rows = rows.join(deal, F.col(f"`{column}`") == F.col("_own"), "left").drop("_own")
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != "_pieces"])
        piece = F.coalesce(F.pmod(hashed, F.col("_pieces")), F.lit(0)).cast("int")
    tasks = max(shuffle_width(spark), math.ceil((found["n"] or 0) / TASK_ROWS))
    dealt = rows.withColumn("_piece", piece).drop("_pieces").repartition(tasks, f"`{column}`", "_piece")
    files = dealt.sortWithinPartitions(f"`{column}`", "_piece").mapInArrow(_writer(column, folder, GROUP_ROWS), "files bigint")
    return files.agg(F.sum("files")).first()[0] or 0


def _writer(column: str, folder: str, group_rows: int):
    """Task that writes rows sorted by entity and piece. It is sent whole: workers need
    not have this package."""
    def write(batches: Iterator) -> Iterator:
        import os
        import re
        import uuid

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        attempt = uuid.uuid4().hex
        now, out, held, files = None, None, [], 0

        def flush() -> None:
            table = pa.Table.from_batches(held)
            out.write_table(table, row_group_size=max(1, table.num_rows))
            held.clear()

        def close() -> None:
            if out is not None:
                if held:
                    flush()
                out.close()
                entity, n = now
                os.replace(f"{folder}/{entity}/.{attempt}", f"{folder}/{entity}/{entity}{f'-{n}' if n else ''}_1m.parquet")

        for batch in batches:
            if not batch.num_rows:
                continue
            names, pieces = batch.column(column), batch.column("_piece")
            rest = batch.select([c for c in batch.schema.names if c not in (column, "_piece")])
            other = pc.or_(pc.not_equal(names[1:], names[:-1]), pc.not_equal(pieces[1:], pieces[:-1]))
            starts = [0, *(i + 1 for i in pc.indices_nonzero(other).to_pylist()), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                # A partitioned write spells these characters so.
                entity = re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", names[a].as_py())
                if now != (entity, pieces[a].as_py()):
                    close()
                    now, files = (entity, pieces[a].as_py()), files + 1
                    os.makedirs(f"{folder}/{entity}", exist_ok=True)
                    out = pq.ParquetWriter(f"{folder}/{entity}/.{attempt}", rest.schema, compression="snappy", store_schema=False)
                held.append(rest.slice(a, b - a))
                if sum(x.num_rows for x in held) >= group_rows:
                    flush()
        close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return write


def migrate(spark: SparkSession, root: str, kind: str, store_path: str,
            store_schema: T.StructType, keys: list[str], sort_cols: list[str]) -> list[str]:
    """Upsert legacy files into the partitioned store as run 0. Stored files
    were already de-duplicated; ``pos`` is the row's ts so the order is total."""
    rows = read_legacy(spark, root, kind)
    if kind != "options":
        rows = rows.withColumn("volume", F.coalesce("volume", F.lit(0).cast("bigint")))
    rows = (rows.withColumn("ingest_run", F.lit(0).cast("bigint"))
            .withColumn("request_seq", F.lit(0).cast("bigint"))
            .withColumn("pos", F.lit(0)))
    col = partition_column(store_schema)
    rows = rows.withColumn(col, partition_value("ts", "day" if col == "trade_date" else "month"))
    return CommitStore(spark, store_path, store_schema, keys, ["ingest_run", "request_seq", "pos"],
                       sort_cols, sort_cols[0]).upsert(rows)

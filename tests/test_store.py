"""Partitioned Parquet store: upsert semantics, pruning, idempotence, stream."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.sources.store import read_store, trade_month, upsert_store
from barsmith.streaming.upsert_stream import run_upsert_stream

SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("close", T.DoubleType()), T.StructField("ingest_run", T.LongType()),
    T.StructField("request_seq", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("trade_month", T.StringType())])
KEYS, ORDER = ["symbol", "ts"], ["ingest_run", "request_seq", "pos"]
JAN = 1704067200  # 2024-01-01 00:00 UTC
FEB = 1706745600  # 2024-02-01 00:00 UTC


def batch(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, ts bigint, close double, ingest_run bigint, "
                                     "request_seq bigint, pos int")
    return df.withColumn("trade_month", trade_month("ts"))


def snapshot(spark, path):
    return sorted(tuple(r) for r in read_store(spark, path, SCHEMA).select(
        "symbol", "ts", "close", "ingest_run").collect())


def files_of(path, month):
    d = os.path.join(path, f"trade_month={month}")
    return {f: os.path.getmtime(os.path.join(d, f)) for f in os.listdir(d)
            if f.endswith(".parquet")}


def test_missing_store_reads_empty(spark):
    assert read_store(spark, tempfile.mkdtemp() + "/none", SCHEMA).count() == 0


def test_upsert_newest_wins_and_only_touched_months(spark):
    path = tempfile.mkdtemp() + "/store"
    b1 = batch(spark, [("A", JAN + 60, 1.0, 1, 1, 0), ("A", JAN + 60, 2.0, 1, 2, 0),
                       ("A", FEB + 60, 3.0, 1, 3, 0), ("B", FEB + 120, 4.0, 1, 3, 1)])
    assert sorted(upsert_store(spark, path, b1, SCHEMA, KEYS, ORDER, ["symbol", "ts"])) == \
        ["2024-01", "2024-02"]
    assert snapshot(spark, path) == [("A", JAN + 60, 2.0, 1), ("A", FEB + 60, 3.0, 1),
                                     ("B", FEB + 120, 4.0, 1)]
    jan_before = files_of(path, "2024-01")
    b2 = batch(spark, [("A", FEB + 60, 9.0, 2, 0, 0), ("C", FEB + 180, 5.0, 2, 1, 0)])
    assert upsert_store(spark, path, b2, SCHEMA, KEYS, ORDER, ["symbol", "ts"]) == ["2024-02"]
    assert files_of(path, "2024-01") == jan_before  # untouched month not rewritten
    snap = snapshot(spark, path)
    assert ("A", FEB + 60, 9.0, 2) in snap and ("C", FEB + 180, 5.0, 2) in snap
    # Same batch again: nothing changes (idempotent re-run).
    upsert_store(spark, path, b2, SCHEMA, KEYS, ORDER, ["symbol", "ts"])
    assert snapshot(spark, path) == snap
    # An older run arriving late cannot override newer rows.
    late = batch(spark, [("A", FEB + 60, 0.5, 1, 99, 9)])
    upsert_store(spark, path, late, SCHEMA, KEYS, ORDER, ["symbol", "ts"])
    assert snapshot(spark, path) == snap


def test_empty_batch_writes_nothing(spark):
    path = tempfile.mkdtemp() + "/store"
    empty = batch(spark, [("A", JAN, 1.0, 1, 1, 0)]).where("false")
    assert upsert_store(spark, path, empty, SCHEMA, KEYS, ORDER, ["symbol", "ts"]) == []
    assert not os.path.exists(path)


def test_month_is_ist_month(spark):
    # 2024-01-31 19:00 UTC is 2024-02-01 00:30 IST.
    df = spark.createDataFrame([(1706727600,)], "ts bigint")
    assert df.select(trade_month("ts")).collect()[0][0] == "2024-02"


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp()
    landing_schema = T.StructType([f for f in SCHEMA.fields if f.name != "trade_month"])
    rows1 = [("A", JAN + 60 * i, float(i), 1, i, 0) for i in range(20)]
    rows2 = [("A", JAN + 60 * i, 100.0 + i, 2, i, 0) for i in range(10, 30)]
    cols = "symbol string, ts bigint, close double, ingest_run bigint, request_seq bigint, pos int"
    spark.createDataFrame(rows2, cols).write.mode("append").json(root + "/landing")
    spark.createDataFrame(rows1, cols).write.mode("append").json(root + "/landing")
    run_upsert_stream(spark, root + "/landing", landing_schema,
                      lambda b: b.withColumn("trade_month", trade_month("ts")),
                      root + "/stream_store", SCHEMA, KEYS, ORDER, ["symbol", "ts"],
                      checkpoint=root + "/ckpt", max_files_per_trigger=1)
    upsert_store(spark, root + "/batch_store", batch(spark, rows1 + rows2), SCHEMA, KEYS, ORDER,
                 ["symbol", "ts"])
    assert snapshot(spark, root + "/stream_store") == snapshot(spark, root + "/batch_store")
    assert len(snapshot(spark, root + "/stream_store")) == 30


def test_staged_batches_are_removed(spark):
    from barsmith.session import checkpoint_root
    root = checkpoint_root(spark).replace("file:", "")
    before = {d for d in os.listdir(root) if d.startswith("barsmith-upsert-batch")}
    path = tempfile.mkdtemp() + "/store"
    upsert_store(spark, path, batch(spark, [("A", JAN, 1.0, 1, 1, 0)]), SCHEMA, KEYS, ORDER,
                 ["symbol", "ts"])
    after = {d for d in os.listdir(root) if d.startswith("barsmith-upsert-batch")}
    assert after == before
    assert snapshot(spark, path) == [("A", JAN, 1.0, 1)]


def test_store_reads_are_pruned_and_pushed(spark):
    from pyspark.sql import functions as F
    path = tempfile.mkdtemp() + "/store"
    upsert_store(spark, path, batch(spark, [("A", JAN, 1.0, 1, 1, 0), ("B", FEB, 2.0, 1, 1, 0)]),
                 SCHEMA, KEYS, ORDER, ["symbol", "ts"])
    months = read_store(spark, path, SCHEMA).where(F.col("trade_month").isin("2024-01"))
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_month" in plan and "2024-01" in plan
    one = read_store(spark, path, SCHEMA).where(F.col("symbol") == "A").select("ts", "close")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,A)]" in plan
    assert "ReadSchema: struct<symbol:string,ts:bigint,close:double>" in plan
    assert [tuple(r) for r in one.collect()] == [(JAN, 1.0)]


def test_one_symbol_reads_one_bucket(spark, tmp_path):
    import re

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from barsmith.sources import store as S
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ts", T.LongType()),
                           T.StructField("ingest_run", T.LongType()), T.StructField("trade_date", T.StringType()),
                           T.StructField(S.BUCKET_COLUMN, T.IntegerType())])
    rows = spark.range(20_000).select(
        F.concat(F.lit("S"), (F.col("id") % 100).cast("string")).alias("symbol"), F.col("id").alias("ts"),
        F.lit(1).cast("bigint").alias("ingest_run"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 4 + 1).cast("string")).alias("trade_date"))
    rows = rows.withColumn(S.BUCKET_COLUMN, S.symbol_bucket("symbol", 16))
    path = str(tmp_path / "s")
    S.upsert_store(spark, path, rows, schema, ["symbol", "ts"], ["ingest_run"], ["symbol", "ts"])
    one = S.read_entity(spark, path, schema, "symbol", "S7", 16)
    assert one.count() == 200
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*symbol_bucket", plan) and "EqualTo(symbol,S7)" in plan
    files = S.read_store(spark, path, schema).inputFiles()
    assert len(one.inputFiles()) <= len(files)
    scanned = spark.read.schema(schema).parquet(path).where(
        F.col(S.BUCKET_COLUMN) == one.first()[S.BUCKET_COLUMN]).count()
    assert scanned < 20_000 / 8


@pytest.mark.parametrize("block", [1, 3, 50_000])
def test_rows_out_of_order_across_blocks(spark, tmp_path, block):
    from barsmith.plans.queries import store as Q
    ts = [5, 6, 4, 7, 8, 9, 3, 10, 11, 2]
    rows = [("S1", t, "2024-01") for t in ts] + [("S0", 1, "2024-02")]
    spark.createDataFrame(rows, "symbol string, ts long, trade_month string").coalesce(1).write.parquet(str(tmp_path / "s"))
    got = {r.trade_month: (r.n_rows, r.n_out_of_order) for r in
           Q.out_of_order(spark.read.parquet(str(tmp_path / "s")), block).collect()}
    assert got == {"2024-01": (10, 3), "2024-02": (1, 1)}


def test_a_stream_rewrites_the_store_once(spark, tmp_path, monkeypatch):
    """However many micro-batches; what a stopped run has read is merged by the next."""
    from barsmith.streaming import upsert_stream as US
    root, calls, real = str(tmp_path), [], US.upsert_store
    cols = "symbol string, ts bigint, close double, ingest_run bigint, request_seq bigint, pos int"
    landing_schema = T.StructType([f for f in SCHEMA.fields if f.name != "trade_month"])

    def land(run):
        spark.createDataFrame([("A", JAN + 60 * i, 10.0 * run + i, run, i, 0) for i in range(6)], cols) \
            .repartition(3).write.mode("append").json(f"{root}/landing")

    def run():
        run_upsert_stream(spark, f"{root}/landing", landing_schema,
                          lambda b: b.withColumn("trade_month", trade_month("ts")), f"{root}/store", SCHEMA, KEYS,
                          ORDER, ["symbol", "ts"], checkpoint=f"{root}/ckpt", max_files_per_trigger=1)

    def stopped(*args, **kw):
        raise RuntimeError("stopped")

    land(2)
    monkeypatch.setattr(US, "upsert_store", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        run()
    assert not os.path.exists(f"{root}/store")
    monkeypatch.setattr(US, "upsert_store", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    land(1)
    run()
    assert len(calls) == 1 and not os.path.exists(f"{root}/ckpt-pending")
    assert snapshot(spark, f"{root}/store") == [("A", JAN + 60 * i, 20.0 + i, 2) for i in range(6)]
    land(3)
    run()
    assert snapshot(spark, f"{root}/store") == [("A", JAN + 60 * i, 30.0 + i, 3) for i in range(6)]
    run()  # nothing landed
    assert len(calls) == 2

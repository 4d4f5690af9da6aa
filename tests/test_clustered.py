"""Clustered files and reads of many symbols: results against plain filters, and
what they open."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.sources import store as S
from barsmith.sources.clustered import ClusteredStore

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ts", T.LongType()),
                       T.StructField("close", T.DoubleType()), T.StructField("trade_date", T.StringType())])
DAYS, SYMBOLS = 6, 100


def candles(spark, n=24_000):
    """A third of the rows are of one symbol; the others spread over 100."""
    at = F.col("id")
    symbol = F.when(at % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.hash("id") % SYMBOLS).cast("string")))
    return spark.range(n).select(symbol.alias("symbol"), at.alias("ts"), (at * 0.5).alias("close"),
                                 F.concat(F.lit("2024-01-0"), (at * DAYS / n).cast("int") + 1).alias("trade_date"))


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(tuple, a.select(*cols).collect()), key=repr) == sorted(map(tuple, b.select(*cols).collect()), key=repr)


def scanned(df):
    """Sums of a metric of the file scans of a finished query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, found = [plan], {"numFiles": 0, "numOutputRows": 0}
    while leaves:
        node = leaves.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            leaves.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            leaves.append(node.plan())
        elif name == "FileSourceScanExec":
            for m in found:
                found[m] += node.metrics().apply(m).value()
        else:
            leaves += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = ClusteredStore(spark, str(tmp_path_factory.mktemp("c") / "store"), SCHEMA, "symbol", 1000)
    made.write(candles(spark))
    return made


def test_reads_equal_filters(spark, store):
    rows = candles(spark)
    names = spark.createDataFrame([("HOT",), ("S7",), ("S-3",), ("none",), (None,), ("S7",)], "symbol string")
    assert same(store.read(), rows)
    assert same(store.read(["S7"]), rows.where("symbol = 'S7'"))
    assert same(store.read(names), rows.where("symbol IN ('HOT', 'S7', 'S-3')"))
    assert same(store.read(names, 5000, 9000), rows.where("symbol IN ('HOT', 'S7', 'S-3') AND ts BETWEEN 5000 AND 9000"))
    assert same(store.read(first_ts=23_000), rows.where("ts >= 23000"))
    assert store.read(["none"]).count() == 0 and store.read(["S7"], 50_000).count() == 0
    assert store.read(names.where("false")).count() == 0


def test_files_have_about_one_size_and_a_hot_symbol_is_split(spark, store):
    sizes = [r[1] for r in store.index().groupBy("file").agg(F.sum("n_rows")).collect()]
    assert sum(sizes) == 24_000 and 20 <= len(sizes) <= 28 and max(sizes) < 2_500
    hot = store.index().where("symbol = 'HOT'").groupBy("trade_date").agg(F.countDistinct("file").alias("n")).collect()
    assert min(r.n for r in hot) > 1


def test_one_symbol_opens_fewer_files_than_buckets(spark, store, tmp_path):
    """The same rows in 16 buckets a day: 96 files of 250 rows against 24 of 1000."""
    schema = T.StructType([*SCHEMA.fields, T.StructField(S.BUCKET_COLUMN, T.IntegerType())])
    path = str(tmp_path / "buckets")
    S.write_partitions(candles(spark).withColumn(S.BUCKET_COLUMN, S.symbol_bucket("symbol", 16)), path,
                       ["symbol", "ts"], S.partition_columns(schema))
    bucketed = scanned(S.read_entity(spark, path, schema, "symbol", "S7", 16))
    clustered = scanned(store.read(["S7"]))
    assert clustered["numFiles"] <= bucketed["numFiles"] <= 2 * DAYS
    assert clustered["numFiles"] < len(store.files()) / 3
    days = scanned(store.read(["S7"], 0, 24_000 // DAYS - 1))
    assert days["numFiles"] <= 2


def test_a_symbol_table_prunes_buckets_at_run_time(spark, tmp_path):
    schema = T.StructType([*SCHEMA.fields, T.StructField(S.BUCKET_COLUMN, T.IntegerType())])
    path, names = str(tmp_path / "buckets"), str(tmp_path / "names")
    rows = candles(spark).where("symbol <> 'HOT'").withColumn(S.BUCKET_COLUMN, S.symbol_bucket("symbol", 16))
    S.write_partitions(rows, path, ["symbol", "ts"], S.partition_columns(schema))
    spark.createDataFrame([("S7",), ("S-3",), ("",), (None,), ("S7",)], "symbol string").write.parquet(names)
    read = S.read_entities(spark, path, schema, "symbol", spark.read.parquet(names), 16)
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    assert same(read, rows.where("symbol IN ('S7', 'S-3')").select(*schema.names))
    every = scanned(S.read_store(spark, path, schema))
    found = scanned(read)
    assert found["numOutputRows"] < every["numOutputRows"] / 4 and found["numFiles"] < every["numFiles"] / 4
    # A table too large to broadcast prunes nothing, and finds the same.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = S.read_entities(spark, path, schema, "symbol", spark.read.parquet(names), 16)
        assert same(read, rows.where("symbol IN ('S7', 'S-3')").select(*schema.names))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_bloom_filter_skips_row_groups(spark, tmp_path):
    """One file per range holds every other name of it: statistics cannot tell, the
    Bloom filter can."""
    made = ClusteredStore(spark, str(tmp_path / "s"), SCHEMA, "symbol", 10 ** 9)
    rows = spark.range(200_000).select(F.sha2((F.col("id") * 2).cast("string"), 256).alias("symbol"), F.col("id").alias("ts"),
                                       F.lit(0.5).alias("close"), F.lit("2024-01-01").alias("trade_date"))
    made.write(rows)
    data = spark.read.schema(SCHEMA).parquet(*made.files())
    absent, held = (F.sha2(F.lit(str(i)), 256) for i in (7, 8))
    assert scanned(data.where(F.col("symbol") == absent))["numOutputRows"] == 0
    assert scanned(data.where(F.col("symbol") == held))["numOutputRows"] > 0


def test_generations(spark, tmp_path):
    made = ClusteredStore(spark, str(tmp_path / "s"), SCHEMA, "symbol", 1000)
    assert made.read().count() == 0 and made.files() == [] and made.vacuum() == 0
    made.write(candles(spark, 3000))
    old = made.read()
    second = made.write(candles(spark, 900))
    assert made.read().count() == 900 and old.count() == 3000
    # A write that stopped before its index was whole is not read.
    stopped = str(tmp_path / "s" / "_index" / "generation=99999999999999999-stopped")
    os.makedirs(stopped)
    assert made.read().count() == 900 and made.generations()[-1] == second
    assert made.vacuum(keep=1) == 1 and made.read().count() == 900 and len(made.generations()) == 1


def test_nulls_repeats_and_no_rows(spark, tmp_path):
    made = ClusteredStore(spark, str(tmp_path / "s"), SCHEMA, "symbol", 2)
    rows = spark.createDataFrame([(None, 1, 1.0, "d"), ("A", None, 2.0, "d"), ("A", 5, None, None), ("A", 5, 3.0, "d"),
                                  ("A", 5, 3.0, "d"), ("", 6, 4.0, "d")], SCHEMA)
    made.write(rows)
    assert same(made.read(), rows)
    assert same(made.read(["A"]), rows.where("symbol = 'A'"))
    assert same(made.read(["A", ""], 5, 6), rows.where("symbol IN ('A', '') AND ts BETWEEN 5 AND 6"))
    made.write(rows.where("false"))
    assert made.read().count() == 0

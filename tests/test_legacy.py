"""Original per-entity file layout: one scan, entity from the path, migration."""

import os
import tempfile

import pandas as pd

from barsmith.plans import jobs as J
from barsmith.schemas import CANDLE_KEYS
from barsmith.sources.legacy import migrate, read_legacy


def write_candles(path, ts0, n, price):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pd.DataFrame({"ts": [ts0 + 60 * i for i in range(n)],
                  "datetime": ["x"] * n, "open": [price] * n, "high": [price] * n,
                  "low": [price] * n, "close": [price] * n, "volume": [1] * n}) \
        .to_parquet(path, index=False)


def test_read_and_migrate_legacy_layout(spark):
    root = tempfile.mkdtemp()
    write_candles(f"{root}/stocks/RELIANCE/RELIANCE_1m.parquet", 1672717500, 3, 10.0)
    write_candles(f"{root}/stocks/M&M/M&M_1m.parquet", 1672717500, 2, 20.0)
    write_candles(f"{root}/spot/nifty/NIFTY_1m.parquet", 1609472700, 4, 30.0)
    stocks = read_legacy(spark, root, "stocks")
    got = sorted((r.symbol, r.close) for r in stocks.collect())
    assert got == [("M&M", 20.0)] * 2 + [("RELIANCE", 10.0)] * 3
    assert {r.symbol for r in read_legacy(spark, root, "spot").collect()} == {"NIFTY"}
    store = tempfile.mkdtemp() + "/stocks"
    assert migrate(spark, root, "stocks", store, J.CANDLE_STORE, CANDLE_KEYS,
                   ["symbol", "ts"]) == ["2023-01-03"]
    assert J.read_store(spark, store, J.CANDLE_STORE).count() == 5


def test_legacy_options_with_null_typed_columns(spark):
    """Uncast all-null option columns are stored with Parquet's null type."""
    root = tempfile.mkdtemp()
    os.makedirs(f"{root}/options/nifty")
    n = None
    pd.DataFrame({"ts": [1735703100], "datetime": ["x"], "underlying": ["NIFTY"],
                  "option_type": ["CE"], "expiry_type": ["WEEK"],
                  "expiry_code": pd.Series([1], dtype="int8"), "atm_strike": [n],
                  "strike_offset": pd.Series([0], dtype="int8"), "moneyness": [""],
                  "strike": [n], "spot": [n], "open": [n], "high": [n], "low": [n],
                  "close": [n], "volume": [0], "oi": [0], "iv": [n]}) \
        .to_parquet(f"{root}/options/nifty/NIFTY_OPTIONS_1m.parquet", index=False)
    row = read_legacy(spark, root, "options").collect()[0]
    assert row.underlying == "NIFTY" and row.strike is None and row.expiry_code == 1


def test_migrate_from_the_command_line(spark):
    from barsmith.__main__ import main
    root = tempfile.mkdtemp()
    write_candles(f"{root}/stocks/INFY/INFY_1m.parquet", 1672717500, 4, 15.0)
    store = tempfile.mkdtemp() + "/stocks"
    assert main(["migrate", "--kind", "stocks", "--legacy-root", root, "--store", store,
                 "--granularity", "month"], spark=spark) == 0
    assert os.path.isdir(f"{store}/trade_month=2023-01")
    got = J.read_store(spark, store, J.candle_store("month")).collect()
    assert {(r.symbol, r.close) for r in got} == {("INFY", 15.0)} and len(got) == 4


def test_folders_are_filled_at_the_same_time(spark, tmp_path, monkeypatch):
    """Entities wait for the file system together, and each keeps all its files."""
    from barsmith.sources import legacy as L
    used = []
    real = L.ThreadPoolExecutor
    monkeypatch.setattr(L, "ThreadPoolExecutor", lambda n: used.append(n) or real(n))
    rows = [(f"S{i % 9}", i) for i in range(90)]
    spark.createDataFrame(rows, "sym string, ts long").repartition(3).write.partitionBy("sym").parquet(str(tmp_path / "w"))
    written = len(list((tmp_path / "w").glob("sym=*/*.parquet")))
    assert L.to_legacy_layout(spark, str(tmp_path / "w"), "sym", str(tmp_path / "stocks")) == written and used[0] > 1
    got = read_legacy(spark, str(tmp_path), "stocks").select("symbol", "ts").collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_tasks_write_the_entity_files(spark, tmp_path, monkeypatch):
    """Rows go straight into the layout, without a rename by the driver: an entity has one
    file, a large one several, in the folders that a partitioned write would name."""
    from barsmith.sources import legacy as L
    monkeypatch.setattr(L, "FILE_ROWS", 100)
    monkeypatch.setattr(L, "GROUP_ROWS", 7)
    names = ["big", "M&M", "a b", "a-1", "", None, "é", *(f"x{chr(c)}y" for c in range(1, 128) if chr(c) not in "\n\r")]
    rows = [(n, i, n or "") for n in names for i in range(500 if n == "big" else 3)]
    df = spark.createDataFrame(rows, "sym string, ts long, datetime string").repartition(5)
    df.write.partitionBy("sym").parquet(str(tmp_path / "w"))
    monkeypatch.setattr(L, "ThreadPoolExecutor", None)
    n = L.to_legacy_layout(spark, df, "sym", f"file:{tmp_path}/stocks")
    files = sorted(p for p in (tmp_path / "stocks").rglob("*") if p.is_file())
    folders = {p.name.split("=", 1)[1] for p in (tmp_path / "w").glob("sym=*")}
    assert n == len(files) and {p.parent.name for p in files} == folders
    assert {p.name for p in files if p.parent.name == "big"} == {"big_1m.parquet", *(f"big-{i}_1m.parquet" for i in range(1, 5))}
    assert {p.name for p in files if p.parent.name != "big"} == {f"{f}_1m.parquet" for f in folders - {"big"}}
    assert len(pd.read_parquet(tmp_path / "stocks" / L.NO_ENTITY / f"{L.NO_ENTITY}_1m.parquet")) == 6
    got = read_legacy(spark, str(tmp_path), "stocks").select("ts", "datetime").collect()
    assert sorted(map(tuple, got)) == sorted((ts, d) for _, ts, d in rows if d)  # Spark passes over names with "_" in front
    got = read_legacy(spark, str(tmp_path), "stocks").where("symbol in ('big', 'M&M')").select("symbol", "ts").collect()
    assert sorted(map(tuple, got)) == sorted((s, ts) for s, ts, _ in rows if s in ("big", "M&M"))


def test_rows_of_another_file_system_take_the_partitioned_write(spark, tmp_path):
    from barsmith.sources import legacy as L
    rows = [(f"S{i % 9}", i) for i in range(90)]
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.layout.link./in", f"file://{tmp_path}")
    df = spark.createDataFrame(rows, "sym string, ts long")
    assert L.to_legacy_layout(spark, df, "sym", "viewfs://layout/in/stocks") == 9
    got = read_legacy(spark, str(tmp_path), "stocks").select("symbol", "ts").collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_the_layout_query_renames_nothing(spark, tmp_path, monkeypatch):
    """One file an entity, whatever size of partitions the session asks for."""
    import datetime as dt

    from barsmith.plans.queries import QUERIES
    from barsmith.sources import legacy as L
    rows = [(i % 7, dt.datetime(1995, 1, 1) + dt.timedelta(i), float(i), i / 2) for i in range(700)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp, l_extendedprice double, l_quantity double") \
        .repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(L, "ThreadPoolExecutor", None)
    found = QUERIES["legacy_layout_scan"](spark, str(tmp_path))
    assert len(found.inputFiles()) == 7
    assert sorted((r.symbol, r.close) for r in found.collect()) == sorted((f"S{k}", p) for k, _, p, _ in rows)

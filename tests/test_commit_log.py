"""The commit-logged store: landing order, atomic commits, merge on read,
watermarks without a scan, upkeep of log and folders."""

import glob
import os

import pytest
from pyspark.sql import types as T

from barsmith.plans import jobs as J
from barsmith.sources import commit_log as CL
from barsmith.sources.store import trade_date

SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("close", T.DoubleType()), T.StructField("ingest_run", T.LongType()),
    T.StructField("trade_date", T.StringType())])
DAY = 86400
JAN = 1704067200  # 2024-01-01 00:00 UTC


def store(spark, path, **kw):
    return CL.CommitStore(spark, str(path), SCHEMA, ["symbol", "ts"], ["ingest_run"], ["symbol", "ts"], "symbol", **kw)


def batch(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, ts bigint, close double, ingest_run bigint")
    return df.withColumn("trade_date", trade_date("ts"))


def snap(s):
    return sorted((r.symbol, r.ts, r.close) for r in s.read().collect())


def test_the_later_landing_of_one_run_wins(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    for close in (10.0, 20.0, 30.0, 5.0):
        assert s.upsert(batch(spark, [("A", JAN, close, 1)])) == ["2024-01-01"]
        assert snap(s) == [("A", JAN, close)]
    # A later run outranks any landing of an earlier one.
    s.upsert(batch(spark, [("A", JAN, 50.0, 2)]))
    s.upsert(batch(spark, [("A", JAN, 7.0, 1)]))
    assert snap(s) == [("A", JAN, 50.0)]


def test_the_order_survives_rewrites(spark, tmp_path):
    s = store(spark, tmp_path / "s", max_segments=2)
    want = {}
    for i in range(7):
        rows = [("A", JAN + k * 60, float(100 * i + k), 1) for k in range(i, 10)]
        rows += [("B", JAN + DAY * (i % 3), float(i), 1)]
        metrics = {}
        s.upsert(batch(spark, rows), metrics=metrics)
        want.update({(r[0], r[1]): r[2] for r in rows})
        assert snap(s) == sorted((*k, v) for k, v in want.items())
        assert metrics["rows_in"] == len(rows)
    per_day = s.segments().groupBy("part").count().collect()
    assert all(r["count"] <= 2 for r in per_day)


def test_a_commit_writes_its_own_rows_only(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    month = [("A", JAN + DAY * d + 60 * m, 1.0, 1) for d in range(30) for m in range(20)]
    s.upsert(batch(spark, month))
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/s/trade_date=*/*/*.parquet")}
    metrics = {}
    parts = s.upsert(batch(spark, [("A", JAN + DAY * d, 2.0, 1) for d in range(30)]), metrics=metrics)
    assert len(parts) == 30
    assert (metrics["rows_in"], metrics["rows_written"], metrics["n_rewritten"]) == (30, 30, 0)
    assert all(os.path.getmtime(f) == t for f, t in before.items())
    assert sum(r[2] == 2.0 for r in snap(s)) == 30 and len(snap(s)) == 600


@pytest.mark.parametrize("stop_at", ["_commit", "_facts"])
def test_a_stopped_run_leaves_the_old_state(spark, tmp_path, monkeypatch, stop_at):
    s = store(spark, tmp_path / "s", max_segments=1)
    s.upsert(batch(spark, [("A", JAN, 1.0, 1), ("B", JAN + DAY, 1.0, 1)]))
    old = snap(s)

    def stop(*args, **kw):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(CL.CommitStore, stop_at, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            s.upsert(batch(spark, [("A", JAN, 2.0, 2), ("C", JAN + 2 * DAY, 2.0, 2)]))
    assert snap(s) == old  # its files are there, but no commit lists them
    assert len(glob.glob(f"{tmp_path}/s/trade_date=2024-01-0*/segment=*")) == 4
    assert [r.last_ts for r in s.watermarks().where("symbol = 'C'").collect()] == []
    s.upsert(batch(spark, [("A", JAN, 3.0, 3)]))
    s.upsert(batch(spark, [("A", JAN + 60, 3.0, 3)]))
    assert snap(s) == [("A", JAN, 3.0), ("A", JAN + 60, 3.0), ("B", JAN + DAY, 1.0)]
    kept = snap(s)
    assert s.vacuum(keep=1) >= 2
    assert snap(s) == kept
    live = {f"trade_date={r.part}/segment={r.segment}" for r in s.segments().collect()}
    there = {"/".join(f.split("/")[-2:]) for f in glob.glob(f"{tmp_path}/s/trade_date=*/segment=*")}
    assert live <= there and not glob.glob(f"{tmp_path}/s/trade_date=2024-01-03/*")


def test_a_reader_keeps_its_snapshot(spark, tmp_path):
    s = store(spark, tmp_path / "s", max_segments=1)
    s.upsert(batch(spark, [("A", JAN, 1.0, 1)]))
    held = s.read()
    s.upsert(batch(spark, [("A", JAN, 2.0, 1)]))  # rewrites the day
    assert held.first().close == 1.0 and s.read().first().close == 2.0


def test_watermarks_read_the_log_only(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    assert s.watermarks().count() == 0
    s.upsert(batch(spark, [("A", JAN, 1.0, 1), ("A", JAN + 60, 1.0, 1), ("B", JAN + DAY, 1.0, 1)]))
    s.upsert(batch(spark, [("A", JAN + 30, 1.0, 2)]))
    marks = s.watermarks()
    assert sorted(tuple(r) for r in marks.collect()) == [("A", JAN + 60), ("B", JAN + DAY)]
    assert all("/_commits/" in f for f in marks.inputFiles())


def test_reads_are_pruned_and_pushed(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    for i in range(2):
        s.upsert(batch(spark, [(x, JAN + DAY * d, float(i), 1) for x in "AB" for d in range(3)]))
    one = s.read().where("symbol = 'A' AND trade_date = '2024-01-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,A)" in plan and "PartitionFilters: [isnotnull(trade_date" in plan
    assert [r.close for r in one.collect()] == [1.0]
    assert s.read(["2024-01-03"]).count() == 2


def test_micro_batches_are_committed_once(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    assert s.upsert(batch(spark, [("A", JAN, 1.0, 1)]), "q", 0)
    assert s.upsert(batch(spark, [("A", JAN, 2.0, 1)]), "q", 1)
    assert s.upsert(batch(spark, [("A", JAN, 1.0, 1)]), "q", 0) == []  # a replay
    assert s.upsert(batch(spark, [("A", JAN, 2.0, 1)]), "q", 1) == []
    assert snap(s) == [("A", JAN, 2.0)] and s.last_batch("q") == 1
    assert s.upsert(batch(spark, [("A", JAN, 9.0, 1)]), "other", 0)
    assert snap(s) == [("A", JAN, 9.0)]


def test_the_log_is_compacted(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path / "s", max_segments=2)
    for i in range(5):
        s.upsert(batch(spark, [("A", JAN, float(i), 1), ("B", JAN + DAY * i, 1.0, 1)]), "q", i)
    old, marks, live = snap(s), sorted(s.watermarks().collect()), sorted(s.segments().collect())
    # Removing the old files may stop anywhere: no dropped segment comes back.
    files = sorted(s.log().inputFiles())
    gone = []
    monkeypatch.setattr(CL, "remove_path", lambda spark, f: gone.append(f))
    assert s.compact_log(1)
    monkeypatch.undo()
    assert sorted(gone) == files
    for f in sorted(files, reverse=True):
        CL.remove_path(spark, f)
        assert sorted(s.segments().collect()) == live
    assert len(s.log().inputFiles()) == 1
    assert (snap(s), sorted(s.watermarks().collect()), s.last_batch("q")) == (old, marks, 4)
    s.upsert(batch(spark, [("A", JAN, 77.0, 1)]))
    assert ("A", JAN, 77.0) in snap(s)
    assert s.compact_log(1) and not s.compact_log(1)
    assert ("A", JAN, 77.0) in snap(s)


def test_two_writers_lose_no_rows(spark, tmp_path, monkeypatch):
    """A writer that commits while another rewrites the same day."""
    a, b = (store(spark, tmp_path / "s", max_segments=1) for _ in range(2))
    a.upsert(batch(spark, [("A", JAN, 1.0, 1)]))
    facts = CL.CommitStore._facts

    def meanwhile(self, *args):
        monkeypatch.setattr(CL.CommitStore, "_facts", facts)
        out = facts(self, *args)
        b.upsert(batch(spark, [("B", JAN, 2.0, 1)]))
        return out

    monkeypatch.setattr(CL.CommitStore, "_facts", meanwhile)
    a.upsert(batch(spark, [("C", JAN, 3.0, 1)]))
    assert snap(a) == [("A", JAN, 1.0), ("B", JAN, 2.0), ("C", JAN, 3.0)]


def test_empty_batches_and_other_layouts(spark, tmp_path):
    s = store(spark, tmp_path / "s")
    assert s.read().count() == 0 and s.read().schema.names == SCHEMA.names
    assert s.upsert(batch(spark, [("A", JAN, 1.0, 1)]).where("false")) == [] and not os.path.exists(tmp_path / "s")
    # A store written without a log can be read, but not added to.
    batch(spark, [("A", JAN, 1.0, 1)]).write.partitionBy("trade_date").parquet(str(tmp_path / "plain"))
    plain = store(spark, tmp_path / "plain")
    assert snap(plain) == [("A", JAN, 1.0)]
    assert [tuple(r) for r in plain.watermarks().collect()] == [("A", JAN)]
    with pytest.raises(ValueError, match="without a commit log"):
        plain.upsert(batch(spark, [("A", JAN, 1.0, 1)]))


def test_nan_and_null_keys_stay_one_key(spark, tmp_path):
    s = J.open_store(spark, str(tmp_path / "o"), J.OPTION_STORE)
    row = {f.name: None for f in J.OPTION_STORE.fields} | {
        "ts": JAN, "datetime": "x", "underlying": "NIFTY", "option_type": "CE", "expiry_type": "WEEK", "expiry_code": 1,
        "strike_offset": 0, "moneyness": "", "volume": 0, "oi": 0, "ingest_run": 1, "request_seq": 1, "pos": 0,
        "trade_date": "2024-01-01"}
    for strike, close in ((None, 1.0), (float("nan"), 2.0), (None, 3.0)):
        s.upsert(spark.createDataFrame([tuple((row | {"strike": strike, "close": close}).values())], T.StructType(
            [T.StructField(f.name, f.dataType) for f in J.OPTION_STORE.fields])))
    got = s.read().select("strike", "close").collect()
    assert [tuple(r) for r in got] == [(None, 3.0)]


@pytest.mark.parametrize("most", [4, 500_000])
def test_a_commit_shuffles_its_rows_once(spark, tmp_path, monkeypatch, most):
    """Its own rows, and with them those of the days that it rewrites; a batch that
    is read from files is not staged either."""
    from barsmith.operators import dedupe as D
    plans, deal = [], CL.keep_last_by_partition

    def spy(*args):
        found = deal(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(D, "DEALT_ROWS", most)
    monkeypatch.setattr(CL, "keep_last_by_partition", spy)
    monkeypatch.setattr(CL, "stage_batch", None)
    s, want = store(spark, tmp_path / "s", max_segments=2), {}
    for i in range(4):
        rows = [("A", JAN + 3600 * k, float(100 * i + k), 1) for k in range(i, 40)]
        path = str(tmp_path / f"b{i}")
        batch(spark, rows + rows[:1]).write.parquet(path)
        metrics = {}
        s.upsert(spark.read.parquet(path), metrics=metrics, stage=False)
        want.update({(r[0], r[1]): r[2] for r in rows})
        assert metrics["rows_in"] == len(rows) + 1
        assert metrics["n_rewritten"] == (2 if i == 2 else 0)
        assert snap(s) == sorted((*k, v) for k, v in want.items())
    assert [p.count("Exchange") for p in plans] == [1] * 4
    empty = spark.read.parquet(path).where("false")
    assert s.upsert(empty, stage=False) == []

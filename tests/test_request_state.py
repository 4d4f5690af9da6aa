"""Requests followed over micro-batches: missing after a time, re-requests
withdrawn by a later answer."""

import datetime as dt
import tempfile
import time

from barsmith.plans import jobs as J
from barsmith.streaming.ingest_stream import METRICS, batch_metrics, stream_ingest
from barsmith.streaming.request_state import open_requests, request_states
from tests.test_jobs import body, land

T0 = 1672717500
LONG_AGO = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)


def manifest(spark, n):
    rows = [(f"r{i}", 1, i, f"S{i}", str(i), "NSE_EQ", "EQUITY", 1, dt.date(2023, 1, 1), dt.date(2023, 1, 9))
            for i in range(n)]
    return spark.createDataFrame(rows, "request_id string, ingest_run bigint, request_seq bigint, symbol string, "
                                 "security_id string, segment string, instrument string, window_idx int, "
                                 "from_date date, to_date date")


def good(i):
    return {"request_id": f"r{i}", "status": 200, **body([T0 + 60 * i])}


def failed(i, code="DH-904"):
    return {"request_id": f"r{i}", "status": 500, "errorCode": code}


def run(spark, m, root, **kw):
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep", **kw)
    got = request_states(spark, root + "/rep/request_events", m).collect()
    return {r.request_id: (r.state, r.reason, r.n_answers) for r in got}


def test_states_over_two_micro_batches(spark):
    root = tempfile.mkdtemp()
    m = manifest(spark, 8)
    events = root + "/rep/request_events"
    assert request_states(spark, events, m).where("state = 'waiting'").count() == 8
    kw = {"timeout": dt.timedelta(days=1), "asked_at": LONG_AGO}
    land(root + "/l", [good(0), failed(1), failed(2), failed(2), {**good(3), "timestamp": ["soon"]},
                       failed(4), good(4), {"request_id": "r5", "status": 400, "errorCode": "DH-905",
                                            "errorMessage": "No data"}, {"request_id": "nobody", "status": 200}, "not json"])
    first = run(spark, m, root, **kw)
    assert first == {
        "r0": ("answered", "ok", 1), "r1": ("rerequest", "fail", 1), "r2": ("rerequest", "fail", 2),
        "r3": ("rerequest", "bad_ts", 1), "r4": ("answered", "ok", 2), "r5": ("answered", "no_data", 1),
        "r6": ("missing", "missing", 0), "r7": ("missing", "missing", 0)}
    assert {r.request_id for r in open_requests(spark, events, m).collect()} == {"r1", "r2", "r3", "r6", "r7"}
    time.sleep(1.1)
    land(root + "/l", [good(1), good(6), failed(0), failed(2)])
    second = run(spark, m, root, **kw)
    assert second == first | {"r1": ("withdrawn", "ok", 2), "r6": ("withdrawn", "ok", 1)}
    assert {r.request_id for r in open_requests(spark, events, m).collect()} == {"r2", "r3", "r7"}
    # Nothing new has landed: nothing changes, in the store either.
    before = sorted(map(str, J.read_store(spark, root + "/s", J.CANDLE_STORE).collect()))
    assert run(spark, m, root, **kw) == second
    assert sorted(map(str, J.read_store(spark, root + "/s", J.CANDLE_STORE).collect())) == before
    orphan = spark.read.parquet(events).where("event = 'orphan'").collect()
    assert [r.request_id for r in orphan] == ["nobody"]


def test_nothing_is_missing_before_its_time(spark):
    root = tempfile.mkdtemp()
    m = manifest(spark, 3)
    land(root + "/l", [good(0)])
    got = run(spark, m, root, timeout=dt.timedelta(days=3))
    assert {k: v[0] for k, v in got.items()} == {"r0": "answered", "r1": "waiting", "r2": "waiting"}


def test_a_second_micro_batch_wins_in_the_store(spark):
    root = tempfile.mkdtemp()
    m = manifest(spark, 1)
    for price in (10.0, 30.0, 5.0):
        land(root + "/l", [{"request_id": "r0", "status": 200, **body([T0], price)}])
        stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep")
        assert [r.open for r in J.read_store(spark, root + "/s", J.CANDLE_STORE).collect()] == [price]


def test_counts_of_micro_batches(spark):
    root = tempfile.mkdtemp()
    m = manifest(spark, 4)
    kw = {"max_files_per_trigger": 100}
    land(root + "/l", [good(0), failed(1), {**good(2), "timestamp": ["soon"]}])
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep", **kw)
    land(root + "/l", [failed(3)])
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep", **kw)
    land(root + "/l", [good(1), good(3), good(0)])
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep", **kw)
    got = {r.batch_id: [r[c] for c in METRICS] for r in batch_metrics(spark, root + "/rep").collect()}
    assert got == {0: [1, 1, 1, 1], 1: [0, 0, 0, 0], 2: [3, 3, 0, 1]}
    # A micro-batch that is run again adds a row of zeros, which changes nothing.
    row = spark.range(1).selectExpr("0L AS batch_id", *[f"0L AS {c}" for c in METRICS])
    row.write.mode("append").parquet(root + "/rep/batch_metrics")
    again = batch_metrics(spark, root + "/rep").where("batch_id = 0").first()
    assert [again[c] for c in METRICS] == got[0] and again.n_runs == 2

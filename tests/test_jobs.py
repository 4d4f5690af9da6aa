"""End-to-end jobs on literal fixtures: plan -> landed responses -> ingest."""

import datetime as dt
import json
import os
import tempfile

import pytest

from barsmith.plans import jobs as J

MASTER_COLS = ["row_seq", "INSTRUMENT_TYPE", "SYMBOL_NAME", "DISPLAY_NAME", "EXCH_ID",
               "SEM_SMST_SECURITY_ID", "INSTRUMENT", "SERIES", "UNDERLYING_SYMBOL"]
MASTER = [
    (0, "INDEX", "NIFTY", "Nifty 50", "NSE", "13", "INDEX", "", ""),
    (1, "INDEX", "SENSEX", "S&P BSE SENSEX", "BSE", "51", "INDEX", "", ""),
    (2, "EQUITY", "RELIANCE INDUSTRIES", "Reliance", "NSE", "2885", "EQUITY", "EQ", "RELIANCE"),
    (3, "EQUITY", "INFOSYS", "Infosys", "NSE", "1594", "EQUITY", "EQ", "INFY"),
]
D0 = 1609472700  # 2021-01-01 09:15 IST


@pytest.fixture()
def master(spark):
    return spark.createDataFrame(MASTER, ", ".join(
        f"{c} {'bigint' if c == 'row_seq' else 'string'}" for c in MASTER_COLS))


def land(path, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"part-{len(os.listdir(path))}.json"), "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


def body(ts, price=100.0, vol=True):
    n = len(ts)
    b = {"timestamp": [str(t) for t in ts], "open": [str(price)] * n, "high": [str(price)] * n,
         "low": [str(price)] * n, "close": [str(price + i) for i in range(n)]}
    if vol:
        b["volume"] = ["10"] * n
    return b


def test_spot_plan_ingest_split_and_resume(spark, master):
    root = tempfile.mkdtemp()
    store = root + "/spot"
    m1 = J.plan_spot_requests(spark, master, store, dt.date(2021, 1, 5), ingest_run=1)
    reqs = {r.symbol: r for r in m1.collect()}
    assert set(reqs) == {"NIFTY", "SENSEX"}
    assert reqs["NIFTY"].security_id == "13" and reqs["SENSEX"].security_id == "51"
    assert reqs["NIFTY"].from_text == "2021-01-01 00:00:00"
    assert reqs["NIFTY"].to_text == "2021-01-05 23:59:59"
    land(root + "/l1", [
        {"request_id": reqs["NIFTY"].request_id, "status": 200,
         **body([D0, D0 + 60, D0 + 120], vol=False)},
        {"request_id": reqs["SENSEX"].request_id, "status": 400, "errorCode": "DH-905",
         "errorMessage": "Too many rows"},
    ])
    r1 = J.ingest_candles(spark, "spot", m1, root + "/l1", store)
    assert r1.months == ["2021-01-01"]  # day partitions by default
    rows = J.read_store(spark, store, J.CANDLE_STORE)
    assert rows.count() == 3 and rows.where("volume = 0").count() == 3
    first = rows.orderBy("ts").first()
    assert first.datetime == "2021-01-01T09:15:00+05:30" and first.symbol == "NIFTY"
    split = r1.split_manifest.orderBy("from_date").collect()
    assert [(s.from_date, s.to_date) for s in split] == [
        (dt.date(2021, 1, 1), dt.date(2021, 1, 3)), (dt.date(2021, 1, 3), dt.date(2021, 1, 5))]
    summary = {r.symbol: r for r in r1.summary.collect()}
    assert summary["NIFTY"].ok == 1 and summary["SENSEX"].split == 1

    # Next run: the halves. Both return the boundary-day candle; the later half wins.
    m2 = J.next_run_split_manifest(r1.split_manifest, "spot", ingest_run=2)
    halves = sorted(m2.collect(), key=lambda r: r.from_date)
    boundary = 1609645500  # 2021-01-03 09:15 IST
    land(root + "/l2", [
        {"request_id": halves[0].request_id, "status": 200, **body([D0, boundary], 50.0)},
        {"request_id": halves[1].request_id, "status": 200, **body([boundary], 70.0)},
    ])
    r2 = J.ingest_candles(spark, "spot", m2, root + "/l2", store)
    s2 = {r.symbol: r for r in r2.run_summary.collect()}
    assert (s2["SENSEX"].rows_in, s2["SENSEX"].keys_new, s2["SENSEX"].rows_out) == (3, 2, 2)
    assert s2["SENSEX"].resume_date == dt.date(2021, 1, 1)
    sx = {r.ts: r.open for r in J.read_store(spark, store, J.CANDLE_STORE)
          .where("symbol = 'SENSEX'").collect()}
    assert sx == {D0: 50.0, boundary: 70.0}

    # Re-ingesting run 1 replaces NIFTY's rows and adds nothing.
    r3 = J.ingest_candles(spark, "spot", m1, root + "/l1", store)
    n3 = {r.symbol: r for r in r3.run_summary.collect()}["NIFTY"]
    assert (n3.rows_in, n3.keys_new, n3.keys_replaced, n3.rows_out) == (3, 0, 3, 3)

    # Re-plan: each index resumes on the IST day of its stored max(ts).
    m3 = {r.symbol: r for r in
          J.plan_spot_requests(spark, master, store, dt.date(2021, 1, 5), 3).collect()}
    assert m3["NIFTY"].from_date == dt.date(2021, 1, 1)
    assert m3["SENSEX"].from_date == dt.date(2021, 1, 3)
    # Up to date: nothing is planned once the resume day reaches as_of.
    assert J.plan_spot_requests(spark, master, store, dt.date(2021, 1, 1), 4).count() == 0


def test_spot_failure_aborts_the_run(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_spot_requests(spark, master, root + "/s", dt.date(2021, 1, 3), 1)
    land(root + "/l", [{"request_id": r.request_id, "status": 500, "errorCode": "DH-904",
                        "errorMessage": "rate limit"} for r in m.collect()])
    with pytest.raises(Exception, match="request failed"):
        J.ingest_candles(spark, "spot", m, root + "/l", root + "/s")
    assert not os.path.exists(root + "/s")


def test_stocks_zero_fill_missing_and_skip(spark, master):
    root = tempfile.mkdtemp()
    m, missing = J.plan_stock_requests(spark, master, root + "/s", dt.date(2023, 1, 3), 1,
                                       symbols=["RELIANCE", "INFY", "NOPE", "RELIANCE"])
    assert [r.symbol for r in missing.collect()] == ["NOPE"]
    reqs = {r.symbol: r for r in m.collect()}
    assert set(reqs) == {"RELIANCE", "INFY"} and reqs["INFY"].security_id == "1594"
    short = body([1672717500, 1672717560])
    short["open"] = ["1.0"]
    land(root + "/l", [
        {"request_id": reqs["RELIANCE"].request_id, "status": 200, **short},
        {"request_id": reqs["INFY"].request_id, "status": 500, "errorCode": "X",
         "errorMessage": "boom"},
        "not json",
    ])
    res = J.ingest_candles(spark, "stocks", m, root + "/l", root + "/s")
    got = J.read_store(spark, root + "/s", J.CANDLE_STORE).orderBy("ts").collect()
    assert [r.open for r in got] == [1.0, 0.0]
    assert res.metrics["rows_in"] == 2 and res.metrics["rows_written"] == 2
    assert res.metrics["bad_ts_rows"] == 0
    rs = {r.symbol: r for r in res.run_summary.collect()}
    assert (rs["RELIANCE"].rows_in, rs["RELIANCE"].keys_new, rs["RELIANCE"].keys_replaced,
            rs["RELIANCE"].rows_out) == (2, 2, 0, 2)
    assert rs["INFY"].rows_in == 0 and rs["INFY"].resume_date == dt.date(2023, 1, 1)
    assert [r.symbol for r in res.rerequest.collect()] == ["INFY"]
    q = res.quarantine.collect()
    assert sorted(r.request_id or "" for r in q) == ["", reqs["INFY"].request_id]
    assert [r._corrupt_record for r in q if r.request_id is None] == ['"not json"']


def test_options_plan_and_ingest(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_option_requests(spark, master, root + "/o", dt.date(2025, 1, 3), 1)
    assert m.count() == 2 * 252
    pick = {(r.underlying, r.bucket, r.side): r for r in
            m.where("expiry_type = 'WEEK' AND expiry_code = 1").collect()}
    ts = [1735703100, 1735703160]  # 2025-01-01 09:15 and 09:16 IST
    side = {"timestamp": [str(t) for t in ts], "open": ["10", "11"], "high": ["12", "13"],
            "low": ["9", "9"], "close": ["11", "12"], "volume": ["100"], "oi": ["5", "6"],
            "iv": ["0.2"], "strike": ["23650", "23650"], "spot": ["23661.2", "23630.0"]}
    call = pick[("NIFTY", "ATM", "CALL")]
    put = pick[("SENSEX", "ATM-2", "PUT")]
    land(root + "/l", [
        {"request_id": call.request_id, "status": 200, "data": {"ce": side}},
        {"request_id": put.request_id, "status": 200,
         "data": {"pe": dict(side, strike=["77800", ""], spot=["78012.5", "78040"])}},
    ])
    res = J.ingest_options(spark, m, root + "/l", root + "/o")
    assert res.rerequest.count() == 2 * 252 - 2  # every unanswered combo
    assert res.metrics["rows_in"] == 4
    out = J.consumer_view(J.read_store(spark, root + "/o", J.OPTION_STORE)) \
        .orderBy("underlying", "ts").collect()
    assert len(out) == 4
    n0, n1, s0, s1 = out
    assert (n0.option_type, n0.atm_strike, n0.moneyness, n0.strike_offset) == \
        ("CE", 23650.0, "ATM", 0)
    assert n1.atm_strike == 23650.0 and n1.moneyness == "ATM"
    assert n0.volume == 100 and n1.volume == 0 and n1.iv is None and n1.oi == 6
    assert (s0.option_type, s0.atm_strike, s0.strike_offset, s0.moneyness) == \
        ("PE", 78000.0, -2, "OTM")
    assert s1.strike is None and s1.moneyness == ""


def test_stream_ingest_equals_batch_ingest(spark, master):
    from barsmith.streaming.ingest_stream import stream_ingest
    root = tempfile.mkdtemp()
    m, _ = J.plan_stock_requests(spark, master, root + "/b", dt.date(2023, 1, 3), 1,
                                 symbols=["RELIANCE", "INFY"])
    reqs = {r.symbol: r for r in m.collect()}
    t0 = 1672717500
    land(root + "/l", [{"request_id": reqs["RELIANCE"].request_id, "status": 200,
                        **body([t0, t0 + 60, t0 + 120])}])
    land(root + "/l", [{"request_id": reqs["INFY"].request_id, "status": 200,
                        **body([t0, t0 + 60], 5.0)},
                       {"request_id": reqs["RELIANCE"].request_id, "status": 200,
                        **body([t0 + 120, t0 + 180], 7.0)}])
    J.ingest_candles(spark, "stocks", m, root + "/l", root + "/b")
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep",
                  max_files_per_trigger=1)

    def snap(p):
        return sorted((r.symbol, r.ts, r.close) for r in J.read_store(spark, p, J.CANDLE_STORE)
                      .collect())
    assert snap(root + "/s") == snap(root + "/b")
    assert len(snap(root + "/s")) == 6
    # Re-running the stream on the same checkpoint processes nothing new.
    stream_ingest(spark, "stocks", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep")
    assert snap(root + "/s") == snap(root + "/b")
    assert spark.read.parquet(root + "/rep/summary").select("batch_id").distinct().count() == 2


def test_command_line_plan_and_ingest(spark, master, capsys):
    from barsmith.__main__ import main
    root = tempfile.mkdtemp()
    master.write.parquet(root + "/master")
    assert main(["plan", "--kind", "spot", "--master", root + "/master", "--store",
                 root + "/store", "--run", "1", "--as-of", "2021-01-03", "--out",
                 root + "/manifest"], spark=spark) == 0
    reqs = {r.symbol: r for r in spark.read.parquet(root + "/manifest").collect()}
    land(root + "/landing", [
        {"request_id": reqs["NIFTY"].request_id, "status": 200, **body([D0, D0 + 60])},
        {"request_id": reqs["SENSEX"].request_id, "status": 400, "errorCode": "DH-905",
         "errorMessage": "No data"}])
    capsys.readouterr()
    assert main(["ingest", "--kind", "spot", "--manifest", root + "/manifest", "--landing",
                 root + "/landing", "--store", root + "/store", "--reports",
                 root + "/reports"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows_in"] == 2 and out["months"] == ["2021-01-01"]
    summ = {r.symbol: r for r in spark.read.parquet(root + "/reports/summary").collect()}
    assert summ["SENSEX"].no_data == 1 and summ["NIFTY"].ok == 1


def test_register_views_for_sql(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_spot_requests(spark, master, root + "/spot", dt.date(2021, 1, 2), 1)
    nifty = [r for r in m.collect() if r.symbol == "NIFTY"][0]
    land(root + "/l", [{"request_id": nifty.request_id, "status": 200, **body([D0, D0 + 60])}])
    J.ingest_candles(spark, "spot", m.where("symbol = 'NIFTY'"), root + "/l", root + "/spot")
    assert J.register_views(spark, spot=root + "/spot") == ["spot_candles"]
    got = spark.sql("SELECT symbol, count(*) AS n, max(datetime) AS last FROM spot_candles "
                    "WHERE trade_date = '2021-01-01' GROUP BY symbol").collect()
    assert [(r.symbol, r.n, r.last) for r in got] == [("NIFTY", 2, "2021-01-01T09:16:00+05:30")]


def test_month_granularity(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_spot_requests(spark, master, root + "/s", dt.date(2021, 1, 2), 1, "month")
    nifty = [r for r in m.collect() if r.symbol == "NIFTY"][0]
    land(root + "/l", [{"request_id": nifty.request_id, "status": 200, **body([D0, D0 + 60])}])
    res = J.ingest_candles(spark, "spot", m.where("symbol = 'NIFTY'"), root + "/l", root + "/s",
                           granularity="month")
    assert res.months == ["2021-01"]
    assert os.path.isdir(root + "/s/trade_month=2021-01")
    assert J.read_store(spark, root + "/s", J.candle_store("month")).count() == 2


def test_overlapping_windows_later_window_wins(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_spot_requests(spark, master, root + "/s", dt.date(2021, 4, 10), 1)
    nifty = sorted((r for r in m.collect() if r.symbol == "NIFTY"), key=lambda r: r.window_idx)
    assert [(r.from_date, r.to_date) for r in nifty] == [
        (dt.date(2021, 1, 1), dt.date(2021, 4, 1)), (dt.date(2021, 4, 1), dt.date(2021, 4, 10))]
    boundary = 1617248700  # 2021-04-01 09:15 IST, inside both windows (end day included)
    land(root + "/l", [
        {"request_id": nifty[1].request_id, "status": 200, **body([boundary], 2.0)},
        {"request_id": nifty[0].request_id, "status": 200, **body([D0, boundary], 1.0)},
    ])
    J.ingest_candles(spark, "spot", m.where("symbol = 'NIFTY'"), root + "/l", root + "/s")
    got = {r.ts: r.open for r in J.read_store(spark, root + "/s", J.CANDLE_STORE).collect()}
    assert got == {D0: 1.0, boundary: 2.0}


def _accounted(landed, res):
    """Answers in = answers stored, known gaps, split, or in the quarantine."""
    s = [r.asDict() for r in res.summary.collect()]
    fine = sum(r[c] for r in s for c in ("ok", "empty", "no_data"))
    splits = res.split_manifest.count() // 2
    return landed == fine + splits + res.quarantine.count()


def _mixed(reqs, good):
    """One landed line per case; returns the lines."""
    a, b, c, d, e = reqs[:5]
    return [
        {"request_id": a, "status": 200, **good}, {"request_id": a, "status": 200, **good},
        {"request_id": a, "status": 500, "errorCode": "DH-904"},
        {"request_id": b, "status": 400, "errorCode": "DH-906", "errorMessage": "Too long"},
        {"request_id": c, "status": 400, "errorCode": "DH-905", "errorMessage": "No data"},
        {"request_id": d, "status": 500, "errorCode": "DH-904"}, {"request_id": d, "status": 500, "errorCode": "X"},
        {"request_id": e, "status": 200, **dict(good, timestamp=["soon"] + good["timestamp"][1:])},
        {"request_id": "nobody", "status": 200, **good}, "not json"]


def test_every_answer_is_accounted_for(spark, master):
    root = tempfile.mkdtemp()
    names = [f"S{i}" for i in range(6)]
    rows = [(i + 10, "EQUITY", "", "", "NSE", str(i), "EQUITY", "EQ", n) for i, n in enumerate(names)]
    own = spark.createDataFrame(MASTER + rows, ", ".join(
        f"{c} {'bigint' if c == 'row_seq' else 'string'}" for c in MASTER_COLS))
    m, _ = J.plan_stock_requests(spark, own, root + "/s", dt.date(2023, 1, 9), 1, symbols=names)
    reqs = [r.request_id for r in m.orderBy("symbol").collect()]
    lines = _mixed(reqs, body([1672717500, 1672717560]))
    land(root + "/l", lines)
    res = J.ingest_candles(spark, "stocks", m, root + "/l", root + "/s")
    assert _accounted(len(lines), res)
    q = sorted((r.request_id or "", r.outcome) for r in res.quarantine.collect())
    assert q == sorted([("", "orphan"), ("nobody", "orphan"), (reqs[0], "superseded"), (reqs[0], "superseded"),
                        (reqs[3], "fail"), (reqs[3], "superseded"), (reqs[4], "bad_ts")])
    assert sorted((r.request_id, r.outcome) for r in res.rerequest.collect()) == sorted(
        [(reqs[3], "fail"), (reqs[4], "bad_ts"), (reqs[5], "missing")])
    assert res.metrics["rows_in"] == 3 and res.metrics["bad_ts_rows"] == 1
    res.release(spark)


def test_stream_accounts_for_every_answer(spark, master):
    from barsmith.streaming.ingest_stream import stream_ingest
    root = tempfile.mkdtemp()
    m = J.plan_option_requests(spark, master, root + "/o", dt.date(2025, 1, 20), 1).orderBy("request_seq")
    call = [r.request_id for r in m.where("side = 'CALL'").limit(5).collect()]
    good = {"timestamp": ["1735703100", "1735703160"], "open": ["1", "2"], "strike": ["100", None]}
    lines = [{**{k: v for k, v in x.items() if k not in good}, "data": {"ce": {k: x[k] for k in good}}}
             if isinstance(x, dict) and "timestamp" in x else x for x in _mixed(call, good)]
    land(root + "/l", lines)
    stream_ingest(spark, "options", m, root + "/l", root + "/s", root + "/ckpt", root + "/rep")
    read = lambda n: spark.read.parquet(f"{root}/rep/{n}")
    fine = sum(r.ok + r.empty + r.no_data for r in read("summary").collect())
    assert len(lines) == fine + read("split_manifest").count() // 2 + read("quarantine").count()
    assert sorted(r.outcome for r in read("rerequest").collect()) == ["bad_ts", "fail"]
    # An option answer that asks for a shorter range becomes two requests of the next run.
    nxt = J.next_run_split_manifest(read("split_manifest"), "options", 2).orderBy("from_date").collect()
    assert [(r.from_date, r.to_date) for r in nxt] == [
        (dt.date(2025, 1, 1), dt.date(2025, 1, 10)), (dt.date(2025, 1, 10), dt.date(2025, 1, 20))]
    assert nxt[0].request_seq < nxt[1].request_seq and nxt[0].side == "CALL"
    assert len({r.request_id for r in nxt}) == 2


@pytest.mark.parametrize("line", ["not json", "bad timestamp"])
def test_spot_aborts_on_what_cannot_be_read(spark, master, line):
    root = tempfile.mkdtemp()
    m = J.plan_spot_requests(spark, master, root + "/s", dt.date(2021, 1, 3), 1)
    reqs = [r.request_id for r in m.collect()]
    good = body([D0, D0 + 60])
    land(root + "/l", [{"request_id": reqs[0], "status": 200, **good}, line if line == "not json" else
                       {"request_id": reqs[1], "status": 200, **dict(good, timestamp=["x", "y"])}])
    with pytest.raises(Exception, match="request failed"):
        J.ingest_candles(spark, "spot", m, root + "/l", root + "/s")
    assert not os.path.exists(root + "/s")


def test_reingest_adds_no_key_for_null_strikes(spark, master):
    root = tempfile.mkdtemp()
    m = J.plan_option_requests(spark, master, root + "/o", dt.date(2025, 1, 3), 1)
    r = m.where("underlying = 'NIFTY' AND side = 'CALL'").first()
    land(root + "/l", [{"request_id": r.request_id, "status": 200, "data": {"ce": {
        "timestamp": ["1735703100", "1735703160"], "strike": [None, "NaN"], "spot": ["1", "2"]}}}])
    for new in (2, 0):
        res = J.ingest_options(spark, m, root + "/l", root + "/o")
        s = {x.underlying: x for x in res.run_summary.collect()}["NIFTY"]
        assert (s.rows_in, s.keys_new, s.rows_out) == (2, new, 2)


def test_command_line_next_run(spark):
    from barsmith.__main__ import main
    root = tempfile.mkdtemp()
    spark.createDataFrame([("A", "1", "NSE_EQ", "EQUITY", 1, dt.date(2023, 1, 1), dt.date(2023, 1, 3), "f", "t")],
                          "symbol string, security_id string, segment string, instrument string, window_idx int, "
                          "from_date date, to_date date, from_text string, to_text string").write.parquet(root + "/sp")
    assert main(["next-run", "--kind", "stocks", "--split-manifest", root + "/sp", "--run", "5", "--out",
                 root + "/m"], spark=spark) == 0
    assert [r.request_id for r in spark.read.parquet(root + "/m").collect()] == ["stocks|A|2023-01-01|2023-01-03|5"]

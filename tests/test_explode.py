"""Arrays -> rows: the three length policies and the in-range null rule."""

import pytest
from pyspark.sql import functions as F

from barsmith.operators.explode import explode_candles, explode_option_side, select_side
from barsmith.schemas import OPTION_RESPONSE

COLS = "id string, timestamp array<string>, open array<string>, high array<string>, " \
       "low array<string>, close array<string>, volume array<string>"


def resp(spark, rows):
    return spark.createDataFrame(rows, COLS)


def run(df, policy, **kw):
    out = explode_candles(df, policy, carry=["id"], **kw).orderBy("id", "pos").collect()
    return [(r.id, r.pos, r.ts, r.open, r.high, r.low, r.close, r.volume) for r in out]


T3 = ["100", "160", "220"]
P3 = ["1.5", "2.5", "3.5"]


def test_strict_aligned_and_volume_padding(spark):
    df = resp(spark, [("a", T3, P3, P3, P3, P3, ["7"]), ("b", T3, P3, P3, P3, P3, None)])
    got = run(df, "strict")
    assert got[0] == ("a", 0, 100, 1.5, 1.5, 1.5, 1.5, 7)
    assert [g[-1] for g in got] == [7, 0, 0, 0, 0, 0]


def test_strict_misaligned_fails(spark):
    df = resp(spark, [("a", T3, P3[:2], P3, P3, P3, [])])
    with pytest.raises(Exception, match="Misaligned"):
        run(df, "strict", label=F.col("id"))


def test_strict_surplus_price_fails_surplus_volume_ignored(spark):
    with pytest.raises(Exception):
        run(resp(spark, [("a", T3, P3 + ["9"], P3, P3, P3, [])]), "strict")
    got = run(resp(spark, [("a", T3, P3, P3, P3, P3, ["1", "2", "3", "4"])]), "strict")
    assert [g[-1] for g in got] == [1, 2, 3]


def test_empty_or_null_timestamps_give_no_rows(spark):
    df = resp(spark, [("a", [], P3, P3, P3, P3, []), ("b", None, None, None, None, None, None)])
    for policy in ("strict", "zero_fill", "null_fill"):
        assert run(df, policy) == []


def test_zero_fill_short_prices(spark):
    df = resp(spark, [("a", T3, ["1"], P3, P3, None, ["5", "6"])])
    got = run(df, "zero_fill")
    assert [g[3] for g in got] == [1.0, 0.0, 0.0]
    assert [g[6] for g in got] == [0.0, 0.0, 0.0]
    assert [g[7] for g in got] == [5, 6, 0]


def test_null_fill_short_prices(spark):
    got = run(resp(spark, [("a", T3, ["1"], P3, P3, P3, [])]), "null_fill")
    assert [g[3] for g in got] == [1.0, None, None]


def test_in_range_null_permissive_and_strict(spark):
    df = resp(spark, [("a", T3, ["1", None, "3"], P3, P3, P3, ["1", None, "2.9"])])
    got = run(df, "zero_fill")
    assert [g[3] for g in got] == [1.0, None, 3.0]  # not hidden by the zero fill
    assert [g[7] for g in got] == [1, 0, 2]        # volume null -> 0, 2.9 -> 2
    with pytest.raises(Exception):
        run(df, "zero_fill", strict_cells=True)


def test_option_side_null_fill(spark):
    side = {"timestamp": ["100", "160"], "open": ["1"], "high": ["1", "2"], "low": ["1", "2"],
            "close": ["1", "2"], "volume": ["3"], "oi": None, "iv": ["0.2", "0.3"],
            "strike": ["", "14050"], "spot": ["NaN", None]}
    rows = [("r1", 200, None, None, {"ce": side, "pe": None}, None),
            ("r2", 200, None, None, {"ce": None, "pe": None}, None)]
    df = spark.createDataFrame(rows, OPTION_RESPONSE)
    df = df.withColumn("side", F.lit("CALL"))
    sided = df.select("request_id", select_side(F.col("data"), F.col("side")).alias("s"))
    got = explode_option_side(sided, "s", carry=["request_id"]).orderBy("pos").collect()
    assert len(got) == 2 and {r.request_id for r in got} == {"r1"}
    assert [r.open for r in got] == [1.0, None]
    assert [r.volume for r in got] == [3, 0] and [r.oi for r in got] == [0, 0]
    assert [r.strike for r in got] == [None, 14050.0]
    assert [r.spot for r in got] == [None, None]  # NaN and null spot -> null


def test_put_picks_pe(spark):
    side = {"timestamp": ["100"], "open": ["1"], "high": None, "low": None, "close": None,
            "volume": None, "oi": None, "iv": None, "strike": None, "spot": None}
    df = spark.createDataFrame([("r", 200, None, None, {"ce": None, "pe": side}, None)],
                               OPTION_RESPONSE)
    s = df.select(select_side(F.col("data"), F.lit("PUT")).alias("s"))
    assert explode_option_side(s, "s", carry=[]).count() == 1
    s = df.select(select_side(F.col("data"), F.lit("CALL")).alias("s"))
    assert explode_option_side(s, "s", carry=[]).count() == 0


def test_numeric_json_cells(spark, tmp_path):
    """Providers send numbers, not text; text cells keep them exact."""
    import json
    from barsmith.sources.responses import read_intraday_responses
    (tmp_path / "r.json").write_text(json.dumps(
        {"request_id": "a", "timestamp": [1609472700.0, 1609472760], "open": [14000.5, 1e3],
         "high": [1, 2], "low": [1, 2], "close": [1, 2], "volume": [12.0, 3e2]}) + "\n")
    got = explode_candles(read_intraday_responses(spark, str(tmp_path)), "strict",
                          carry=["request_id"]).orderBy("pos").collect()
    assert [(r.ts, r.open, r.volume) for r in got] == [(1609472700, 14000.5, 12),
                                                        (1609472760, 1000.0, 300)]

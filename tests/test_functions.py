"""Scalar expressions against the expected values of the original job."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith import functions as X


def one(spark, col, data=None, schema=None):
    df = spark.createDataFrame(data or [(1,)], schema or "x int")
    return [r[0] for r in df.select(col).collect()]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_to_ist_iso_any_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        got = one(spark, X.epoch_to_ist_iso(F.lit(1609472700)))
        day = one(spark, X.epoch_to_ist_date(F.lit(1609472700 - 9 * 3600 - 20 * 60)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2021-01-01T09:15:00+05:30"]
    # 2020-12-31 18:25 UTC is 23:55 IST, still Dec 31.
    assert day == [dt.date(2020, 12, 31)]


def test_ist_date_crosses_midnight(spark):
    # 2021-01-01 18:30:00 UTC is 2021-01-02 00:00 IST.
    assert one(spark, X.epoch_to_ist_date(F.lit(1609525800))) == [dt.date(2021, 1, 2)]
    assert one(spark, X.epoch_to_ist_date(F.lit(1609525799))) == [dt.date(2021, 1, 1)]


@pytest.mark.parametrize("spot,step,atm", [
    (14013.3, 50, 14000), (48237.5, 100, 48200), (25.0, 50, 0), (75.0, 50, 100),
    (125.0, 50, 100), (175.0, 50, 200), (24.9, 50, 0)])
def test_atm_strike_half_even(spark, spot, step, atm):
    assert one(spark, X.atm_strike(F.lit(spot), F.lit(step))) == [atm]


def test_stored_atm_zero_is_null(spark):
    assert one(spark, X.stored_atm(X.atm_strike(F.lit(20.0), F.lit(50)))) == [None]
    assert one(spark, X.stored_atm(F.lit(14000))) == [14000.0]


@pytest.mark.parametrize("typ,strike,spot,atm,want", [
    ("CE", 14000.0, 14013.3, 14000, "ATM"), ("CE", 13950.0, 14013.3, 14000, "ITM"),
    ("CE", 14050.0, 14013.3, 14000, "OTM"), ("PE", 13950.0, 14013.3, 14000, "OTM"),
    ("PE", 14050.0, 14013.3, 14000, "ITM"), ("CE", 14013.3, 14013.3, 14000, "OTM"),
    ("PE", 14013.3, 14013.3, 14000, "OTM"), ("XX", 14050.0, 14013.3, 14000, "ITM"),
    ("CE", 14000.005, 14013.3, 14000, "ATM"),
    ("CE", None, 14013.3, 14000, ""), ("PE", 14050.0, None, None, "")])
def test_moneyness_truth_table(spark, typ, strike, spot, atm, want):
    df = spark.createDataFrame([(typ, strike, spot, atm)], "t string, k double, s double, a bigint")
    got = df.select(X.guarded_moneyness("t", "k", "s", "a")).collect()[0][0]
    assert got == want


def test_moneyness_uses_zero_atm(spark):
    # ATM 0 is stored as null but still used for moneyness.
    df = spark.createDataFrame([("CE", 0.0, 10.0)], "t string, k double, s double")
    atm = X.atm_strike(F.col("s"), F.lit(50))
    r = df.select(X.guarded_moneyness("t", "k", "s", atm), X.stored_atm(atm)).collect()[0]
    assert r[0] == "ATM" and r[1] is None


@pytest.mark.parametrize("bucket,off", [("ATM", 0), ("ATM+3", 3), ("ATM-7", -7), ("ATM+10", 10)])
def test_strike_offset(spark, bucket, off):
    assert one(spark, X.strike_offset(F.lit(bucket))) == [off]


def test_strike_offset_bad_label_fails(spark):
    with pytest.raises(Exception):
        one(spark, X.strike_offset(F.lit("OTM+1")))


def _windows(spark, start, end, n):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    return [(r.window_idx, r.from_date, r.to_date)
            for r in df.select(F.inline(X.date_windows("s", "e", n))).collect()]


def test_date_windows_cases(spark):
    d = dt.date
    assert _windows(spark, d(2024, 1, 1), d(2024, 1, 1), 30) == []
    assert _windows(spark, d(2024, 1, 2), d(2024, 1, 1), 30) == []
    assert _windows(spark, d(2024, 1, 1), d(2024, 1, 2), 30) == [(1, d(2024, 1, 1), d(2024, 1, 2))]
    assert _windows(spark, d(2024, 1, 1), d(2024, 1, 31), 30) == [(1, d(2024, 1, 1), d(2024, 1, 31))]
    assert _windows(spark, d(2024, 1, 1), d(2024, 2, 1), 30) == [
        (1, d(2024, 1, 1), d(2024, 1, 31)), (2, d(2024, 1, 31), d(2024, 2, 1))]
    w = _windows(spark, d(2024, 1, 1), d(2024, 4, 1), 90)  # 91 days, leap year
    assert w == [(1, d(2024, 1, 1), d(2024, 3, 31)), (2, d(2024, 3, 31), d(2024, 4, 1))]


def test_date_windows_cover_range_without_gaps(spark):
    d = dt.date
    for n in (1, 7, 30, 90):
        w = _windows(spark, d(2023, 11, 17), d(2025, 3, 2), n)
        assert w[0][1] == d(2023, 11, 17) and w[-1][2] == d(2025, 3, 2)
        for a, b in zip(w, w[1:]):
            assert a[2] == b[1] and (a[2] - a[1]).days == n


def test_bisect_mid(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 4)),
                                (dt.date(2024, 1, 1), dt.date(2024, 3, 30))], "f date, t date")
    got = [r[0] for r in df.select(X.bisect_mid("f", "t")).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 2, 14)]


def test_number_parsing(spark):
    rows = [("1.9",), ("-2.7",), ("12",), ("",), (None,), ("x",), ("NaN",),
            ("9007199254740993",), ("1e3",), (" 7 ",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(X.to_long("t"), X.to_double("t")).collect()
    assert [r[0] for r in got] == [1, -2, 12, None, None, None, None, 9007199254740993, 1000, 7]
    dbl = [r[1] for r in got]
    assert dbl[:3] == [1.9, -2.7, 12.0] and dbl[3:7] == [None] * 4


def test_strict_number_parsing_fails(spark):
    df = spark.createDataFrame([("",)], "t string")
    with pytest.raises(Exception):
        df.select(X.to_double("t", strict=True)).collect()


def test_strip_and_first_non_empty(spark):
    df = spark.createDataFrame([(" \tab c\t\n", "", "z"), (None, " ", "q")], "a string, b string, c string")
    got = df.select(X.strip_ws("a"), X.first_non_empty("b", "a", "c")).collect()
    assert got[0][0] == "ab c" and got[0][1] == " \tab c\t\n"
    assert got[1][0] is None and got[1][1] == " "


@pytest.mark.parametrize("text,inc,exc,want", [
    ("NIFTY 500", ["NIFTY 50"], [], True),        # substring trap kept on purpose
    ("Nifty 50", ["NIFTY 50"], ["IT"], True),
    ("NIFTY IT", ["NIFTY"], ["IT"], False),
    ("NIFTY FIN SERVICE", ["NIFTY"], ["FIN"], False),
    ("anything", [], [], True),
    ("anything", [], ["thing"], False),
    ("S&P BSE SENSEX", ["S&P BSE SENSEX", "SENSEX"], ["MIDCAP"], True)])
def test_keywords(spark, text, inc, exc, want):
    df = spark.createDataFrame([(text, inc, exc)], "t string, i array<string>, e array<string>")
    assert df.select(X.matches_keywords("t", "i", "e")).collect()[0][0] is want


@pytest.mark.parametrize("status,code,msg,days,n,want", [
    (200, None, None, 5, 3, "ok"), (200, None, None, 5, 0, "empty"),
    (400, "DH-905", "No Data found", 5, 0, "no_data"), (400, "DH-907", "NO DATA", 1, 0, "no_data"),
    (400, "DH-905", "Invalid", 5, 0, "split"), (400, "DH-906", "bad", 1, 0, "fail"),
    (500, None, "boom", 9, 0, "fail"), (400, None, None, 2, 0, "split")])
def test_classify_response(spark, status, code, msg, days, n, want):
    df = spark.createDataFrame([(status, code, msg, days, n)],
                               "s int, c string, m string, d int, n int")
    assert df.select(X.classify_response("s", "c", "m", "d", n_rows="n")).collect()[0][0] == want

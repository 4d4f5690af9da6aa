"""Instrument master resolution cases (index rules and stock symbols)."""

import pytest

from barsmith.config import INDEX_MATCH_RULES
from barsmith.operators.resolve import missing_symbols, resolve_indices, resolve_symbols

IDX_COLS = ["row_seq", "INSTRUMENT_TYPE", "SYMBOL_NAME", "DISPLAY_NAME", "EXCH_ID",
            "SEM_SMST_SECURITY_ID"]


def master(spark, rows, cols=IDX_COLS):
    return spark.createDataFrame(rows, ", ".join(
        f"{c} {'bigint' if c == 'row_seq' else 'string'}" for c in cols))


def test_index_rules_with_traps(spark):
    rows = [
        (0, "INDEX", "NIFTY", "NIFTY 500", "NSE", "500"),    # substring trap: scores like NIFTY 50
        (1, "INDEX", "NIFTY", "NIFTY 50", "NSE", "13"),      # tie with row 0 -> row 0 wins
        (2, "INDEX", "NIFTY", "NIFTY BANK", "NSE", "25"),    # excluded
        (3, "EQUITY", "NIFTY", "NIFTY 50", "NSE", "99"),     # not an index
        (4, "index", "SENSEX", "S&P BSE SENSEX", "bse", "51"),
        (5, "INDEX", "SENSEX", "SENSEX MIDCAP", "BSE", "52"),  # excluded
        (6, "INDEX", "", "", "BSE", "53"),                    # empty text skipped
    ]
    out = {r.name: r for r in resolve_indices(master(spark, rows), INDEX_MATCH_RULES).collect()}
    assert out["NIFTY_50"].security_id == "500" and out["NIFTY_50"].score == 3
    assert out["SENSEX"].security_id == "51" and out["SENSEX"].score == 3


def test_fallback_and_exchange(spark):
    rows = [(0, "INDEX", "NIFTY", "NIFTY MIDSML", "BSE", "1"),  # fallback, wrong exch: 1
            (1, "INDEX", "NIFTY", "NIFTY SMALL", "NSE", "2"),   # fallback, right exch: 2
            (2, "INDEX", "SENSEX", "SENSEX", "NSE", "3")]       # preferred, wrong exch: 2
    out = {r.name: r for r in resolve_indices(master(spark, rows), INDEX_MATCH_RULES).collect()}
    assert out["NIFTY_50"].security_id == "2" and out["NIFTY_50"].score == 2
    assert out["SENSEX"].security_id == "3" and out["SENSEX"].score == 2


def test_alternative_headers(spark):
    cols = ["row_seq", "InstrumentType", "SymbolName", "DisplayName", "ExchangeId", "SecurityID"]
    rows = [(0, "INDEX", "NIFTY", "NIFTY 50", "NSE", "13"), (1, "INDEX", "SENSEX", "", "BSE", "51")]
    out = {r.name: r.security_id for r in
           resolve_indices(master(spark, rows, cols), INDEX_MATCH_RULES).collect()}
    assert out == {"NIFTY_50": "13", "SENSEX": "51"}


def test_no_candidate_fails(spark):
    rows = [(0, "INDEX", "NIFTY", "NIFTY 50", "NSE", "13")]
    with pytest.raises(Exception, match="Could not find index instrument for SENSEX"):
        resolve_indices(master(spark, rows), INDEX_MATCH_RULES).collect()


def test_missing_security_id_fails(spark):
    rows = [(0, "INDEX", "NIFTY", "NIFTY 50", "NSE", ""), (1, "INDEX", "SENSEX", "", "BSE", "5")]
    with pytest.raises(Exception, match="Missing security ID"):
        resolve_indices(master(spark, rows), INDEX_MATCH_RULES).collect()


STK_COLS = ["row_seq", "EXCH_ID", "INSTRUMENT", "SEM_SMST_SECURITY_ID", "SERIES",
            "UNDERLYING_SYMBOL", "SYMBOL_NAME"]


def test_stock_symbol_rules(spark):
    rows = [
        (0, "NSE", "EQUITY", "1", "BE", "AAA", "A LTD"),    # non-EQ then EQ -> EQ
        (1, "NSE", "EQUITY", "2", "EQ", "AAA", "A LTD"),
        (2, "NSE", "EQUITY", "3", "EQ", "BBB", ""),         # EQ then non-EQ -> EQ
        (3, "NSE", "EQUITY", "4", "SM", "BBB", ""),
        (4, "NSE", "EQUITY", "5", "EQ", "CCC", ""),         # two EQ -> last
        (5, "nse", "equity", "6", "eq", "CCC", ""),
        (6, "NSE", "EQUITY", "7", "BE", "DDD", ""),         # two non-EQ -> first
        (7, "NSE", "EQUITY", "8", "SM", "DDD", ""),
        (8, "NSE", "EQUITY", "9", "EQ", "", "ONLYNAME"),    # found by SYMBOL_NAME only
        (9, "BSE", "EQUITY", "10", "EQ", "EEE", ""),        # wrong exchange
        (10, "NSE", "OPTSTK", "11", "EQ", "FFF", ""),       # not equity
        (11, "NSE", "EQUITY", "", "EQ", "GGG", ""),         # no id: skipped
    ]
    m = master(spark, rows, STK_COLS)
    req = spark.createDataFrame([(s,) for s in ["AAA", "BBB", "CCC", "DDD", "ONLYNAME", "EEE",
                                                "FFF", "GGG", "AAA", "aaa"]], "symbol string")
    got = {r.symbol: (r.security_id, r.matched_on) for r in resolve_symbols(m, req).collect()}
    assert got["AAA"] == ("2", "UNDERLYING_SYMBOL")
    assert got["BBB"][0] == "3" and got["CCC"][0] == "6" and got["DDD"][0] == "7"
    assert got["ONLYNAME"] == ("9", "SYMBOL_NAME")
    assert got["EEE"] == (None, None) and got["aaa"] == (None, None)
    assert len(got) == 9
    assert sorted(r.symbol for r in missing_symbols(m, req).collect()) == \
        ["EEE", "FFF", "GGG", "aaa"]


def test_index_plan_has_no_nested_loop_join(spark):
    rows = [(0, "INDEX", "NIFTY", "NIFTY 50", "NSE", "13"), (1, "INDEX", "SENSEX", "", "BSE", "51")]
    plan = resolve_indices(master(spark, rows), INDEX_MATCH_RULES) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan

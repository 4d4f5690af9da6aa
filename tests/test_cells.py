"""Cells that keep their JSON type, against the parsing of Python's ``int`` and
``float``, which the original uses."""

import json
import math

import pytest
from pyspark.sql import functions as F

from barsmith import functions as X
from barsmith.operators.cells import cell_kinds
from barsmith.operators.explode import explode_candles, explode_option_side
from barsmith.plans import jobs as J
from barsmith.schemas import response_schema

CELLS = [1, 1.9, -1.9, 0, -0.5, True, False, None, "", " ", "7", " 7 ", "+7", "-7", "1.9", "1e3", ".5", "5.",
         "1d", "0x1F", "abc", [], [1], {}, {"v": 1}, 9223372036854775807, -9223372036854775808, 2 ** 53 + 1,
         1e15, 1.5e10, 0.1, 123456789.123456789, 0.99999999999999999999, float("nan")]


def python(fn, x):
    try:
        v = fn(x)
    except (TypeError, ValueError):
        return None
    return None if isinstance(v, float) and math.isnan(v) else v


def test_cells_are_parsed_like_the_original(spark):
    rows = spark.createDataFrame([(i, json.dumps({"a": [c]})) for i, c in enumerate(CELLS)], "i int, line string")
    cell = F.from_json("line", "a array<variant>")["a"][0]
    got = rows.select("i", cell.alias("c")).select(
        "i", X.variant_long("c"), X.variant_double("c"), X.variant_kind("c")).orderBy("i").collect()
    kinds = {int: "number", float: "number", bool: "boolean", str: "text", list: "array", dict: "object"}
    for (i, whole, number, kind), c in zip(got, CELLS):
        assert whole == python(int, c), (c, whole)
        assert number == python(float, c), (c, number)
        assert kind == ("null" if c is None else kinds[type(c)])


def test_whole_numbers_beyond_64_bits_and_missing_cells(spark):
    line = '{"a": [92233720368547758070, 1e300]}'
    row = spark.createDataFrame([(line,)], "line string").select(F.from_json("line", "a array<variant>")["a"].alias("a"))
    one = row.select(X.variant_long(F.col("a")[0]), X.variant_double(F.col("a")[0]), X.variant_long(F.col("a")[1]),
                     X.variant_long(F.get("a", F.lit(5))), X.variant_kind(F.get("a", F.lit(5)))).first()
    assert tuple(one) == (None, 92233720368547758070.0, None, None, None)


@pytest.mark.parametrize("cell", ["1.9", "", None, {"v": 1}])
def test_strict_cells_fail_like_the_original(spark, cell):
    line = json.dumps({"timestamp": [60], "open": [1], "high": [1], "low": [1], "close": [1], "volume": [cell]})
    resp = spark.createDataFrame([(line,)], "line string").select(
        F.from_json("line", response_schema("stocks", "variant")).alias("r")).select("r.*")
    with pytest.raises(Exception, match="bad or missing volume"):
        explode_candles(resp, "zero_fill", [], strict_cells=True).collect()
    assert explode_candles(resp, "zero_fill", []).first().volume == 0


def test_option_side_of_variant_cells(spark):
    side = {"timestamp": [60, "120", 180], "open": [1.5, "2.5"], "strike": ["", 20000, "20050.5"],
            "spot": [None, "20010", 20020.25], "volume": [3.9, "3.9", "4"], "iv": None}
    line = json.dumps({"request_id": "r", "data": {"ce": side}})
    resp = spark.createDataFrame([(line,)], "line string").select(
        F.from_json("line", response_schema("options", "variant")).alias("r")).select("r.*", "r.data.ce")
    rows = [(r.ts, r.open, r.strike, r.spot, r.volume, r.oi, r.iv)
            for r in explode_option_side(resp, "ce", []).orderBy("pos").collect()]
    assert rows == [(60, 1.5, None, None, 3, 0, None), (120, 2.5, 20000.0, 20010.0, 0, 0, None),
                    (180, None, 20050.5, 20020.25, 4, 0, None)]


def test_ingest_of_variant_cells(spark, tmp_path):
    """Fractional text is a bad timestamp with variant cells and a whole one with
    text cells; unreadable lines and two answers to one request are told apart."""
    manifest = spark.sql("""SELECT 'r' || id AS request_id, 1L AS ingest_run, id AS request_seq, 'S' || id AS symbol,
        'x' AS security_id, 'NSE_EQ' AS segment, 'EQUITY' AS instrument, 1 AS window_idx,
        DATE '2024-01-01' AS from_date, DATE '2024-01-02' AS to_date FROM range(4)""")
    day = 1704085200

    def answer(rid, **own):
        body = {"timestamp": [day, str(day + 60)], "open": [1, "1.5"], "high": [2, 2], "low": [1, 1], "close": [1, 1],
                "volume": [1, "2"]}
        return json.dumps({"request_id": rid, "status": 200, **body, **own})

    lines = [answer("r0"), answer("r1", timestamp=[day, f"{day + 60}.5"]), "{bad", answer("r2"), answer("r2", open=[3, 3])]
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing/a.json").write_text("\n".join(lines))
    res = J.ingest_candles(spark, "stocks", manifest, str(tmp_path / "landing"), str(tmp_path / "store"), cells="variant")
    rows = J.read_store(spark, str(tmp_path / "store"), J.CANDLE_STORE)
    assert {(r.symbol, r.ts - day) for r in rows.collect()} == {("S0", 0), ("S0", 60), ("S1", 0), ("S2", 0), ("S2", 60)}
    assert sorted(r.outcome for r in res.quarantine.collect()) == ["bad_ts", "orphan", "superseded"]
    assert {(r.request_id, r.outcome) for r in res.rerequest.collect()} == {("r1", "bad_ts"), ("r3", "missing")}
    J.ingest_candles(spark, "stocks", manifest, str(tmp_path / "landing"), str(tmp_path / "text"))
    assert J.read_store(spark, str(tmp_path / "text"), J.CANDLE_STORE).count() == 6


def test_cell_kinds_of_nested_fields_and_no_answers(spark):
    schema = response_schema("options", "variant")
    line = json.dumps({"request_id": "r", "data": {"ce": {"oi": ["1.5", 2, "", None]}, "pe": {"iv": [0.5, float("nan")]}}})
    resp = spark.createDataFrame([(line,), ("{}",)], "line string").select(F.from_json("line", schema).alias("r")).select("r.*")
    assert {tuple(r) for r in cell_kinds(resp).collect()} == {
        ("data.ce.oi", "text", 1, 1), ("data.ce.oi", "number", 1, 0), ("data.ce.oi", "empty", 1, 1),
        ("data.ce.oi", "null", 1, 1), ("data.pe.iv", "number", 2, 1)}
    assert cell_kinds(resp.where("false")).count() == 0
    with pytest.raises(ValueError):
        cell_kinds(spark.range(1))
    with pytest.raises(ValueError):
        response_schema("stocks", "numbers")

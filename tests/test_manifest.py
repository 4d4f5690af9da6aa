"""Request manifests: option grid, candle windows, split halves."""

import datetime as dt

import pytest

from barsmith.config import STRIKE_BUCKETS
from barsmith.operators.coverage import gap_ranges
from barsmith.plans import manifest as M


def ents(spark, rows):
    return spark.createDataFrame(rows, "entity string, s date, e date")


def test_option_grid_252_per_window_in_request_order(spark):
    df = ents(spark, [("NIFTY", dt.date(2025, 1, 1), dt.date(2025, 3, 1))])
    reqs = M.option_requests(df, "s", "e", ["entity"]).orderBy("request_seq").collect()
    assert len(reqs) == 2 * 252
    assert [r.request_seq for r in reqs] == list(range(504))
    first = reqs[:4]
    assert [(r.expiry_type, r.expiry_code, r.bucket, r.side) for r in first] == [
        ("WEEK", 1, "ATM", "CALL"), ("WEEK", 1, "ATM", "PUT"),
        ("WEEK", 1, "ATM+1", "CALL"), ("WEEK", 1, "ATM+1", "PUT")]
    assert reqs[251].expiry_type == "MONTH" and reqs[251].expiry_code == 3
    assert reqs[251].bucket == STRIKE_BUCKETS[-1] and reqs[252].window_idx == 2
    assert reqs[0].from_text == "2025-01-01" and reqs[0].to_text == "2025-01-31"


def test_candle_requests_overlap_and_text(spark):
    df = ents(spark, [("X", dt.date(2024, 1, 1), dt.date(2024, 6, 1)),
                      ("Y", dt.date(2024, 6, 1), dt.date(2024, 6, 1))])
    reqs = M.candle_requests(df, "s", "e", ["entity"]).orderBy("entity", "window_idx").collect()
    assert [r.entity for r in reqs] == ["X", "X"]
    assert reqs[0].to_date == reqs[1].from_date
    assert reqs[0].from_text == "2024-01-01 00:00:00"
    assert reqs[0].to_text == "2024-03-31 23:59:59"


def test_split_requests(spark):
    df = spark.createDataFrame([("X", 1, dt.date(2024, 1, 1), dt.date(2024, 1, 4)),
                                ("X", 2, dt.date(2024, 1, 4), dt.date(2024, 1, 5)),
                                ("X", 3, dt.date(2024, 1, 5), dt.date(2024, 1, 7))],
                               "entity string, window_idx int, from_date date, to_date date")
    got = M.split_requests(df, ["entity"]).orderBy("window_idx", "half").collect()
    assert [(r.window_idx, r.from_date, r.to_date) for r in got] == [
        (1, dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 2), dt.date(2024, 1, 4)),
        (3, dt.date(2024, 1, 5), dt.date(2024, 1, 6)), (3, dt.date(2024, 1, 6), dt.date(2024, 1, 7))]


def recursion(f, t, leaf_days):
    """The visiting order of a recursion that halves a range, left half first."""
    n = (t - f).days
    if n <= leaf_days:
        return [(f, t)]
    mid = f + (t - f) // 2
    return recursion(f, mid, leaf_days) + recursion(mid, t, leaf_days)


def test_split_tree_is_the_recursion(spark):
    day = dt.date(2024, 1, 1)
    spans = [(i, day + dt.timedelta(i), day + dt.timedelta(i + n)) for i, n in enumerate([0, 1, 2, 3, 7, 30, 89, 90, 365])]
    df = spark.createDataFrame(spans, "window_idx int, from_date date, to_date date")
    for leaf_days in (1, 7):
        got = {}
        for r in M.split_tree(df, [], leaf_days).orderBy("window_idx", "leaf").collect():
            got.setdefault(r.window_idx, []).append(r)
        want = {i: recursion(f, t, leaf_days) for i, f, t in spans if (t - f).days > 1}
        assert {i: [(r.from_date, r.to_date) for r in v] for i, v in got.items()} == want
        for v in got.values():
            assert [r.leaf for r in v] == list(range(1, len(v) + 1))
            assert [r.request_seq for r in v] == sorted(r.request_seq for r in v)


def test_nested_trees_hold_the_same_leaves(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(k, i, day + dt.timedelta(i), day + dt.timedelta(i + n)) for k, i, n in (
        ("a", 1, 90), ("a", 2, 1), ("b", 1, 31), (None, 3, 30), ("b", 1, 31))],
        "k string, window_idx int, from_date date, to_date date")
    flat = M.split_tree(df, ["k"], 7).drop("from_text", "to_text")
    nested = M.split_tree(df, ["k"], 7, nested=True)
    assert nested.count() == 4
    own = nested.selectExpr("k", "window_idx", "inline(leaves)").select(*flat.columns)
    assert sorted(map(str, own.collect())) == sorted(map(str, flat.collect()))


def test_the_tree_query_sends_no_leaves(spark):
    """Leaves are many times the windows: none is shuffled."""
    from barsmith.plans.queries import QUERIES
    found = QUERIES["split_tree"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan
    rows = [r for r in found.collect() if r.max_days == 90 and r.n_leaves > 2]
    assert rows and all(r.n_leaves == len(r.leaves.split(" ")) for r in rows)
    assert all(r.last_seq - r.first_seq == r.n_leaves - 1 for r in rows)


def test_whole_windows_are_asked_once_a_first_day(spark):
    """What is asked of the trees equals what each tree gives, and the whole windows that
    begin on one day share one answer."""
    from pyspark.sql import functions as F
    day, ran = dt.date(2024, 1, 1), spark.sparkContext.accumulator(0)
    spans = [(k, i, day + dt.timedelta(i % 2), day + dt.timedelta(i % 2 + n)) for k in ("a", "b", None) for i, n in enumerate([30] * 8 + [31, 29, 2, 1, 0])]
    df = spark.createDataFrame([*spans, spans[0], ("c", 3, None, day), ("c", 4, day, None)], "k string, window_idx int, from_date date, to_date date")
    count = F.udf(lambda n: ran.add(1) or n, "int")
    lists = lambda x: [F.size(x).alias("n"), F.array_min(x["request_seq"]).alias("first"),
                       F.array_join(F.transform(x, lambda r: r["to_date"].cast("string")), " ").alias("ends")]
    want = M.split_tree(df, ["k"], 7, nested=True).select("k", "window_idx", *lists(F.col("leaves")))
    counted = lambda x: [count(lists(x)[0]).alias("n"), *lists(x)[1:]]
    got = M.split_tree(df, ["k"], 7, asked=counted, usual=30).withColumn("first", M.window_seq() + F.col("first")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want.collect()))) and len(got) == 8 * 3 + 1 + 3 * 3
    assert ran.value == 2 + 3 * 3


def test_the_tree_query_on_rows_of_its_own(spark, tmp_path):
    from barsmith.plans.queries import QUERIES
    ends = [(1, 0), (1, 200), (2, 0), (2, 200), (None, 5), (None, 95), (3, 7), (3, 8), (4, 9), (4, None), (5, 1), (5, 92)]
    rows = [(k, n if n is None else dt.datetime(1999, 12, 20) + dt.timedelta(n, 3600)) for k, n in ends]
    spark.createDataFrame(rows, "o_custkey long, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    want = []
    for k, a, b in ((1, 0, 200), (2, 0, 200), (None, 5, 95), (3, 7, 8), (5, 1, 92)):
        for size, leaf in ((90, 1), (30, 7)):
            for i, s in enumerate(range(a, b, size), 1):
                f, t = (dt.date(1999, 12, 20) + dt.timedelta(n) for n in (s, min(s + size, b)))
                if (t - f).days > 1:
                    pieces = recursion(f, t, leaf)
                    seq = [i * 100000 + (x - dt.date(1970, 1, 1)).days for x, _ in pieces]
                    want.append((k, size, i, len(pieces), " ".join(f"{x}/{(y - x).days}" for x, y in pieces), min(seq), max(seq)))
    found = QUERIES["split_tree"](spark, str(tmp_path))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert "(_day#" in found._jdf.queryExecution().optimizedPlan().toString()


def test_split_tree_refuses_what_it_cannot_finish(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2024, 1, 1))], "window_idx int, from_date date, to_date date")
    with pytest.raises(Exception, match="cannot be halved"):
        M.split_tree(df, []).collect()


def test_asked_trees_refuse_what_they_cannot_finish(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2024, 1, 1))], "window_idx int, from_date date, to_date date")
    for usual in (30, 1461):
        with pytest.raises(Exception, match="cannot be halved"):
            M.split_tree(df, [], asked=lambda x: [x], usual=usual).collect()


def test_gap_ranges(spark):
    days = [("A", d) for d in (2, 3, 4, 9, 11, 12, 13, 14, 15, 16)] + [("B", 5)]
    df = spark.createDataFrame([(e, dt.date(2024, 1, d), dt.date(2024, 1, d + 1)) for e, d in days],
                               "symbol string, from_date date, to_date date")
    got = sorted((r.symbol, r.gap, r.window_idx, r.from_date.day, r.to_date.day) for r in gap_ranges(df, "symbol", 4).collect())
    assert got == [("A", 1, 1, 2, 5), ("A", 2, 1, 9, 10), ("A", 3, 1, 11, 15), ("A", 3, 2, 15, 17), ("B", 1, 1, 5, 6)]
    assert gap_ranges(df.limit(0), "symbol", 4).count() == 0

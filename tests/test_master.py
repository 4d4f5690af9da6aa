"""Instrument master CSV: stripped headers/cells, line order across files."""

import tempfile

from barsmith.sources.instruments import land_master, read_master_csv


def test_master_line_order_and_trim(spark):
    root = tempfile.mkdtemp()
    for i, name in enumerate(["a.csv", "b.csv"]):
        with open(f"{root}/{name}", "w") as fh:
            fh.write(" SECURITY_ID ,\tSYMBOL_NAME,EMPTY\n")
            for j in range(50):
                n = i * 50 + j
                fh.write(f"{n},\t name{n} \t,\n")
    landed = land_master(spark, root, tempfile.mkdtemp() + "/landed")
    got = sorted((r.row_seq, r.SECURITY_ID, r.SYMBOL_NAME, r.EMPTY) for r in landed.collect())
    assert [g[0] for g in got] == list(range(100))
    assert all(g[1] == str(g[0]) and g[2] == f"name{g[0]}" and g[3] is None for g in got)


def test_master_columns_are_text(spark):
    root = tempfile.mkdtemp()
    with open(f"{root}/m.csv", "w") as fh:
        fh.write("A,B\n007,1.50\n")
    df = read_master_csv(spark, root)
    row = df.collect()[0]
    assert row.A == "007" and row.B == "1.50"


def test_quoted_cells_as_a_standard_reader_takes_them(spark, tmp_path):
    import csv

    from barsmith.sources.instruments import land_master
    rows = [["1", 'ACME "X", LTD', "NSE"], ["2", "two\nlines", "BSE"], ["3", "", "NSE"], ["4", "plain", "a\tb"],
            ["5", '""', "NSE"], ["6", "back\\slash", "NSE"]]
    with open(tmp_path / "m.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["ID", "NAME", "EXCH"], *rows])
    got = land_master(spark, str(tmp_path / "m.csv"), str(tmp_path / "out")).orderBy("row_seq").collect()
    with open(tmp_path / "m.csv", newline="", encoding="utf-8") as f:
        want = list(csv.reader(f))[1:]
    assert [[r.ID, r.NAME or "", r.EXCH] for r in got] == want
    assert [r.row_seq for r in got] == list(range(6))

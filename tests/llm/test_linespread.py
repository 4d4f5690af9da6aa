import random
import time
from collections import Counter

import pytest

from barsmith.llm import linespread as ls


def brute(rows, min_sites):
    sites = {}
    key = lambda x: x.strip(ls.WHITE)
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if key(x):
                sites.setdefault(key(x), set()).add(s or "")
    out, copies = [], Counter(t for _, t, _ in rows)
    for i, t, _ in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        parts = t.split("\n")
        hit = [key(x) != "" and len(sites[key(x)]) >= min_sites for x in parts]
        if copies[t] > 1 or all(h or not key(x) for x, h in zip(parts, hit)):
            hit = [False] * len(parts)
        out.append((i, "\n".join(x for x, h in zip(parts, hit) if not h), len(parts), sum(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,min_sites", [(1, 8), (2, 4), (3, 60)])
def test_equals_brute_force(spark, seed, min_sites):
    rnd = random.Random(seed)
    common = [f"common line {i}" for i in range(12)] + ["  padded\t", "é ü", "$1 \\n"]
    rows = []
    for i in range(400):
        lines = [f"own {i} {k} " + "x" * rnd.randint(0, 30) for k in range(rnd.randint(0, 5))]
        lines += [rnd.choice(common[:rnd.randint(1, 15)]) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 3))]
        lines += rnd.choice([[], [""], [" "]])
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines), f"site{rnd.randint(0, 99) if rnd.random() < .7 else 0}"))
    rows += [(900, None, "a"), (901, "", "a"), (902, "\n\n", None), (903, "common line 1", None), rows[3]]
    rows += [(1000 + i, "copy one\ncopy two", f"s{i}") for i in range(20)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows],
                                 "doc_id long, text string, source string, pos int, line string").repartition(4)
    found = ls.clean(docs, min_sites=min_sites)
    got = sorted(((r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()), key=str)
    assert got == brute(rows, min_sites)


def test_native_and_empty(spark):
    docs = spark.createDataFrame([(1, "a\nb", "s")], "doc_id long, text string, source string")
    found = ls.clean(docs)
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert ls.clean(docs.limit(0)).count() == 0
    assert found.first().text == "a\nb"


def test_what_is_spared(spark):
    """Copies, and texts of spread lines alone; no other text keeps such a line."""
    menu = [f"menu entry {k} of every site" for k in range(6)]
    rows = [(i, "\n".join([*menu, f"own {i}"]), f"s{i}") for i in range(9)]
    rows += [(20, "\n".join(menu), "s1"), (21, "twice\n" + menu[0], "s2"), (22, "twice\n" + menu[0], "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.row.doc_id: r.text for r in ls.clean(docs).collect()}
    assert got == {i: f"own {i}" for i in range(9)} | {i: t for i, t, _ in rows[9:]}


def test_nothing_is_spared_on_request(spark):
    """With spare=False copies and texts of spread lines alone lose theirs as well."""
    rnd = random.Random(7)
    menu = [f"menu entry {k} of every site" for k in range(6)]
    rows = [(i, "\n".join(rnd.sample(menu, 4) + [f" own {i}"] * rnd.randint(0, 2)), f"s{i % 17}") for i in range(60)]
    rows += [(100 + i, "\n".join(["twice", menu[0], "", menu[1] + " "]), f"s{i}") for i in range(3)]
    rows += [(200 + i, "\n".join(menu), "s1") for i in range(2)] + [(210, menu[2] + "\n\t", None)]
    rows += [(220, None, "a"), (221, "", "a"), (222, "\n\n", "a"), rows[5]]
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            sites.setdefault(x.strip(ls.WHITE), set()).add(s or "")
    want = []
    for i, t, _ in rows:
        parts = [] if t is None else t.split("\n")
        left = [x for x in parts if not x.strip(ls.WHITE) or len(sites[x.strip(ls.WHITE)]) < ls.MIN_SITES]
        want.append((i, None if t is None else "\n".join(left), len(parts), len(parts) - len(left)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = [(r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in ls.clean(docs, spare=False).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    by = {r[0]: r[1:] for r in got}
    assert by[100] == by[102] == ("twice\n", 4, 2) and by[200] == ("", 6, 6) and by[210] == ("\t", 2, 1)


def test_very_long_texts(spark):
    """Time grows with the text, not with its square."""
    rows = [(i, "\n".join(f"common line {k}" if k % 2 else f"line {k} of text {i}" for k in range(20_000)), f"s{i}")
            for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    start = time.time()
    got = {r.row.doc_id: (r.text, r.n_removed) for r in ls.clean(docs).collect()}
    assert time.time() - start < 40
    assert got == {i: ("\n".join(x for x in t.split("\n") if "common" not in x), 10_000) for i, t, _ in rows}

import random
import re
from itertools import permutations

import numpy as np
import pytest

from barsmith.llm import filteraudit as fa

COLUMNS = "doc_id long, text string, source string, mask int, n string, part string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, source in rows:
        bad = fails(text or "")
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows):
            bad.add("E")
        docs.append((source or "", bad, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                hit = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(hit)
                out[part, "".join(order), step + 1] = [
                    len(left), len(hit), sum(f in d[1] for d in own) - len(hit),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in hit), sum(d[3] for d in hit)]
        for k in [k for k in out if k[0] == part]:
            out[k].append(shapley[k[1][k[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(fa.failures(docs, lab)).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa.TOTALS) for r in got}
    assert len(out) == len(got)
    return out


def test_lehmer_intervals_cover_the_orders():
    orders = list(permutations(range(4)))
    for size in range(1, 5):
        for start in permutations(range(4), size):
            low, high = fa.rank_interval(start, 4)
            assert [o[:size] == start for o in orders] == [low <= r < high for r in range(24)]
    ends = fa.removal_ends(4)
    covered = np.zeros((16, 25), int)
    np.add.at(covered, (ends[:, 0], ends[:, 2]), ends[:, 3])
    assert (np.cumsum(covered, 1)[1:, :24] == 1).all() and not covered[0].any()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        body = rnd.choices(words, k=rnd.choice([3, 49, 50, 60, 150]))
        if rnd.random() < .4:
            body = body[:20] * 3
        if rnd.random() < .3:
            body = [w.upper() + "ABC" for w in body]
        if rnd.random() < .3:
            body.insert(1, rnd.choice("#$%&*|"))
        rows.append((rnd.randint(0, 400), rnd.choice([" ", "\t", "\n ", "\x0b"]).join(body), rnd.choice(["a", "b", None, ""])))
    rows += [(500 + k, rows[k % 5][1], "a") for k in range(30)]
    rows += [rows[3], rows[3], (rows[3][0], "other", "b")]
    rows += [(600, None, "c"), (601, "", None), (None, "", "a"), (None, None, "a"), (602, " \n ", "c"), (603, "é\xa0Ü " * 60, "c")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i, _, _ in rows if rnd.random() < .6]
    assert found(spark, rows, labels) == brute(rows, labels)


def test_long_text_hot_copies_and_empty(spark):
    long = " ".join(f"Word{i}" for i in range(200_000))
    rows = [(1, long, "s"), (2, long, "s")] + [(10 + i, "same text", "hot") for i in range(200)]
    labels = [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    got = found(spark, rows, labels)
    assert got == brute(rows, labels)
    assert got["hot", "EABCD", 1][:2] == (1, 199)
    docs = spark.createDataFrame([], COLUMNS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert fa.audit(fa.failures(docs, lab)).count() == 0
    none = found(spark, rows, [])
    assert all(v[4:6] == (0, 0) for v in none.values())

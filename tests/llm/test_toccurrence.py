import random
import re

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import toccurrence as tj
from barsmith.llm.components import components


def shingles(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, groups=12, copies=25):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    boiler = " ".join(rnd.choice(vocab) for _ in range(15))
    rows = []
    for g in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 20, 60, 150]))]
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                k = rnd.randrange(max(1, len(w)))
                w[k:k + rnd.choice([0, 1, 1])] = [rnd.choice(vocab)] * rnd.choice([0, 1, 1])
            t = " ".join(w) or "x"
            t = t.upper() if rnd.random() < 0.2 else t
            rows.append(t + ("\n" + boiler if rnd.random() < 0.2 else ""))
    rows += [None, "", " \t", "a b", "A  B", "a b c d", "a b c d e", "a b c d e", boiler, boiler]
    rnd.shuffle(rows)
    out = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    return out + [(None, rows[0]), (None, "only here once, without any id at all"), out[5]]


@pytest.mark.parametrize("seed,limit,bucket", [(1, 2048, 24 << 20), (2, 8, 3000), (3, 4, 24 << 20)])
def test_equals_brute_force(spark, monkeypatch, seed, limit, bucket):
    monkeypatch.setattr(tj, "BUCKET_BYTES", bucket)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n int, class string")
    got = tj.jaccard_components(docs.repartition(3), family_limit=limit).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "q"), (2, "q"), (None, "a b c d e f"), (9, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in tj.keep_one(docs).collect() if r.doc_id) == [
        (1, "a b c d e f"), (2, "q"), (8, ""), (9, None)]
    assert tj.keep_one(docs).count() == 5
    assert tj.keep_one(docs.limit(0)).count() == 0


def test_divide_skip_finds_every_pair():
    """Without the skip of connected candidates, all linked pairs are found."""
    rnd = random.Random(5)
    sets = []
    for _ in range(12):
        base = rnd.sample(range(500), rnd.randint(1, 60))
        for _ in range(8):
            own = [x if rnd.random() < 0.95 else rnd.randrange(500, 900) for x in base]
            sets.append(np.array(sorted(set(own)), np.uint64))
    sets.sort(key=len)
    f = tj.Family(np.array([len(s) for s in sets]), sets, 80)
    for q in range(1, len(sets)):
        f.root = np.arange(len(sets))
        want = {c for c in range(q) if 100 * len(np.intersect1d(sets[q], sets[c])) >= 80 * len(np.union1d(sets[q], sets[c]))}
        assert set(f.partners(q)) == want


@pytest.mark.parametrize("total", [10, 400])
def test_merge(total):
    rnd = np.random.default_rng(1)
    lists = [np.unique(rnd.integers(0, 90, total // 4)) for _ in range(5)]
    who, count = tj.merged(lists)
    assert dict(zip(who.tolist(), count.tolist())) == {
        x: sum(x in set(v.tolist()) for v in lists) for x in set(np.concatenate(lists).tolist())}


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(-5, -3), (7, 7)]
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_sets_of_a_column():
    texts = ["a b c d e a b c d e", "A b\x0bc d E", None, "x"]
    gram, first = tj.shingle_sets(pa.array(texts))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    assert gram[first[1]] in gram[:first[1]]


def test_keep_one_loses_no_other_text_of_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a"), (1, text, "b"), (1, "quite another text under the same id", "c"), (2, text, "d"),
            (None, text, "e"), (3, None, "f"), (3, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(((r.doc_id, r.text, r.source) for r in tj.keep_one(docs).collect()), key=str)
    again = sorted(((r.doc_id, r.text, r.source) for r in tj.keep_one(docs.repartition(2, "source")).collect()), key=str)
    assert got == again
    assert sorted((str(i), str(t)) for i, t, _ in got) == sorted([
        ("1", text), ("1", rows[2][1]), ("None", text), ("3", "None")])


def test_bucket_numbers_beyond_16_bits():
    run = tj._lists_of(100_000)
    gram = np.array([5, 5], np.uint64).view(np.uint8).reshape(-1, 8)[:, :6]
    row = {"bucket": 70_000, "class": np.array([1, 2], np.uint64).tobytes(), "size": np.array([1, 1], np.int32).tobytes(),
           "n": np.array([1, 1], np.int32).tobytes(), "gram": gram.tobytes(), "doc_id": b"", "no_id": b"",
           "doc_class": b"", "doc_n": b""}
    out = run(pa.Table.from_pylist([row], schema=pa.schema(
        [("bucket", pa.int32()), *((c, pa.binary()) for c in tj.SENT_COLUMNS)])))
    found = np.frombuffer(b"".join(out.column("gram").to_pylist()), np.uint64)
    assert set(found.tolist()) == {5 | (70_000 & 0xFFFF) << 48}


def test_keep_one_judges_every_text_of_an_id(spark):
    """A copy goes although its id stays with another text, and an id keeps one of its near copies."""
    text = [f"w{i}" for i in range(60)]
    copy, near = " ".join(text), " ".join(text[:-1] + ["other"])
    rows = [(2, copy), (5, copy), (5, "a text that only this id has"), (7, "x " + near), (9, near.upper()),
            (11, "near copies of one id " * 30), (11, "near copies of one id " * 30 + "end"), (12, ""), (13, ""), (13, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in tj.keep_one(docs).collect())
    assert [r for r in got if r[0] != 11] == [(2, copy), (5, rows[2][1]), (12, ""), (13, "")]
    assert len(got) == 5 and got[2][1] in (rows[5][1], rows[6][1])

import hashlib
import random
import re

import pytest

from barsmith.llm import decontaminate as dc

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[p:p + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    hit |= set(range(p, p + n))
                    ids |= wins[tuple(w[p:p + n])]
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "été", "a1", "zu", "rr", "Foo"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(20)]
    items += [(90, items[5][1]), (91, None), (92, " ,. "), (None, text(12)), (93, "w1 " * 14)]
    docs = []
    for i in range(60):
        t = text(rnd.randint(0, 60))
        if i % 3 == 0:
            t += " " + rnd.choice(items)[1].__str__() + " " + text(5)
        docs.append((i, t))
    return docs + [(100, None), (101, ""), (102, "w1 " * 40), (0, docs[0][1])], items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 300)])
def test_equals_brute_force(spark, seed, block):
    docs, items = corpus(seed)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs],
                              "doc_id long, text string, n_hit string, item_id int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.report(dc.scan(d, b, block_bytes=block)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)
    kept = dc.clean(d, b, block_bytes=block)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(docs, items) if not r[5])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.report(dc.scan(d.limit(0), b)).count() == 0
    r = dc.report(dc.scan(d, b.limit(0))).first()
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)
    assert dc.report(dc.scan(d, b)).first().n_hit == 2

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barsmith.llm import lexsearch as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = {c: c + 32 for c in range(65, 91)}
DOCS, ITEMS = "doc_id long, text string, id int, n string, at int", "item_id long, text string, score int, item string"


def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[1]]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                    for t in terms(text) if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(*r, 7, "y") for r in items], ITEMS)
    got = lx.search(d, q, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed,k,cells", [(1, 20, None), (2, 3, 2000), (3, 1, 300)])
def test_equals_brute_force(spark, seed, k, cells, monkeypatch):
    rnd = random.Random(seed)
    if cells:  # several tiles, several groups of items, several blocks
        monkeypatch.setattr(lx, "TILE_CELLS", cells)
        monkeypatch.setattr(lx, "ITEM_ROWS", 4)
        monkeypatch.setattr(lx, "BLOCK_BYTES", 300)
    vocab = [f"T{i}" for i in range(40)] + ["é", "日本", "9", "a-b", "ÉÄ", "x_y"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rnd.choices(vocab, weight, k=rnd.randint(0, 30)))) for i in range(120)]
    docs += [(500 + i, docs[7][1]) for i in range(30)] + [docs[7], (None, docs[7][1]), (None, "T1 T2"), (900, None), (901, ""),
                                                         (902, "--"), (903, "t0 " * 3000)]
    items = [(i, " ".join(rnd.choices(vocab, weight, k=rnd.randint(1, 8)))) for i in range(10)]
    items += [(3, "t3 t3 T3"), (50, None), (51, ""), (52, "nowhere"), (None, "t5"), items[0]]
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 20) == []
    assert found(spark, [(1, "a")], [], 20) == []
    assert found(spark, [(1, None)], [(1, "a")], 20) == []


def test_partial_sums_stay_exact():
    most = np.array([1 << 32] * 10, np.int64)
    cuts = lx.vocabulary_cuts(most)
    assert cuts[0][0] == 0 and cuts[-1][1] == 10 and all(b == c for (_, b), (c, _) in zip(cuts, cuts[1:]))
    assert len(cuts) > 1 and all(0 < (b - a) * (1 << 32) * lx.IMPACT < lx.EXACT for a, b in cuts)
    rnd = np.random.default_rng(5)
    weights = rnd.integers(1 << 31, 1 << 32, (3, 10))
    impact = rnd.integers(900_000, 1_000_000, 20)
    rows, term = np.repeat([0, 1], 10), np.tile(np.arange(10), 2)
    got = lx.tile_scores(weights, rows, term, impact, 2, cuts)
    want = [[sum(int(w) * int(x) for w, x in zip(ws, impact[r * 10:r * 10 + 10])) for r in range(2)] for ws in weights]
    assert got.tolist() == want
    with pytest.raises(ValueError):
        lx.vocabulary_cuts(np.array([1 << 40]))
    # Lengths beyond 64-bit products.
    big = lx.impacts(np.array([3]), np.array([10**9]), 10**12, 10**18)
    assert big.tolist() == [10**9 * 3 // (3000 + 12 * (75 + 25 * 10**9 * 10**12 // 10**18))]

import hashlib
import math
import random
import re

import pytest

from barsmith.llm import spotsigs as ss

COLUMNS = "doc_id long, text string, id int, h string, body string, own int"
ANCHORS = set(ss.anchor_words())


def digest(x):
    return int(hashlib.md5(x.encode()).hexdigest()[:ss.DIGITS], 16)


def signatures(text):
    words = [w for w in re.split(r"[\x00-/:-`{-\x7f]+", text.lower()) if w]
    content = [i for i, w in enumerate(words) if w not in ANCHORS]
    out = {digest(" ".join([words[p - 1], *[words[i] for i in content[k:k + ss.CHAIN]]]))
           for k, p in enumerate(content) if p and words[p - 1] in ANCHORS and k + ss.CHAIN <= len(content)}
    return sorted(out) or [digest("\n" + text)]


def near(a, b):
    if a == b:
        return 1.0
    part = [math.floor(math.log(len(x)) / math.log(1 / ss.FLOOR)) for x in (a, b)]
    if abs(part[0] - part[1]) > 1 or min(len(a), len(b)) < ss.FLOOR * max(len(a), len(b)):
        return 0.0
    both = len(set(a) & set(b))
    return both / (len(a) + len(b) - both)


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, text) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + follow[:cut]
        a, b, c = signatures(text), signatures(edited), signatures(follow)
        out.append((i, len(text), edited, a, b, c, near(a, b), near(a, c)))
    return out


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], COLUMNS).repartition(3)
    got = [tuple(r) for r in ss.edited_pairs(docs).collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = [*"the of and der la que".split(), *[f"w{i}" for i in range(30)], "Über", "É日本", "don't", "THE"]
    texts = [rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, k=rnd.randint(0, 60))) for _ in range(120)]
    rows = [(rnd.randint(-10**6, 10**6) * 2 + 1, t) for t in texts]
    rows = list({i: (i, t) for i, t in rows}.values())
    rows += [(10, None), (12, ""), (14, "the"), (16, "no anchors here whatever"), (18, "  "), (None, "the a b c d"),
             (20, texts[0]), (22, texts[0]), (24, "the big red house stands " * 9), (26, "a" * 50_000 + " the x y z " * 20_000)]
    assert found(spark, rows) == brute(rows)


def test_repeated_rows_single_row_and_empty(spark):
    rows = [(1, "the one two three four"), (2, "the b c d e"), (2, "the b c d e"), (3, "of x y z")]
    got = found(spark, rows)
    want = brute([rows[0], rows[1], rows[3]])
    assert got == [want[0], want[1], want[1], want[2]]
    assert found(spark, rows[:1]) == brute(rows[:1])
    twice = found(spark, [(5, "the p q r s"), (5, "the t u v w"), (6, "of p q r s")])
    assert len(twice) == 3 and sorted(r[0] for r in twice) == [5, 5, 6]
    assert found(spark, []) == []


def test_native_and_similar(spark):
    docs = spark.createDataFrame([(1, "the a b c"), (2, "of d e f")], "doc_id long, text string")
    plan = ss.edited_pairs(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))
    rows = spark.createDataFrame([("the quick brown fox jumped over the lazy dog again today",)], "t string")
    r = ss.with_signatures(rows, {"s": "t"}).select("s", ss.fingerprint("s").alias("f")).first()
    assert r.f == "".join(f"{x:015x}" for x in r.s) and len(r.s) == 2

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from barsmith.llm import fertility
from barsmith.llm.tokens import vocabulary_path

TEXTS = [None, "", " \n ", "a b c a b c", "x\nx\n x\nx\n\n\ny", "été 漢字 #$ <b>|&* %", "the " * 60,
         "A a A a A a", "one two three\none two three\n", "a  b", "w " * 3 + "v " * 3]


def brute(t):
    t = t or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {g for g, n in Counter(grams).items() if n > 1}
    hit = {j for i, g in enumerate(grams) if g in many for j in (i, i + 1, i + 2)}
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    ids = [i for w in words for i in sp.encode(w)]
    n = len(ids)
    h = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0
    bpe = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    other = bpe.encode(" ".join(words), add_special_tokens=False).ids
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), n,
            sum(sp.is_byte(i) for i in ids), h, len(other), 0, bits(other)]


def bits(ids):
    n = len(ids)
    return -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0


def test_measures_equal_brute_force():
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choice("ab cd ef gh é\n".split(" ")) for _ in range(rnd.randint(0, 80)))
                     for _ in range(80)]
    found = fertility.measure_column(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert np.allclose([x[i] for x in found], brute(t), rtol=0, atol=1e-9), t


def test_verdicts(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice(["th", "er", "on", "ing", "es"]) for _ in range(rnd.randint(1, 4)))
             for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(60, 300))), "en") for i in range(200)]
    rows += [(900, "%%% ### $$$ " * 5 + " ".join(f"{w}%%%###" for w in vocab[:200]), "en"),
             (901, None, None), (902, "too short", "en"), (903, " ".join(vocab[:3] * 40), "en"),
             (904, "\U00020000 \U00020001\U00020002 " * 3 + " ".join("\U00020000%d" % i for i in range(80)), "en")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, "
                                 "n_words int, entropy string")
    got = {r.row.doc_id: r for r in fertility.judge(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(200))
    assert not any(got[i].kept for i in range(900, 905))
    assert [got[i].base_failed for i in range(900, 905)] == [False, True, True, True, False]
    assert fertility.judge(docs.limit(0)).count() == 0


def test_few_kinds_of_tokens_alone_are_rejected(spark):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice(["th", "er", "on", "ing", "es"]) for _ in range(rnd.randint(1, 4)))
             for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(60, 300))), "en") for i in range(200)]
    few = sorted(set(vocab), key=lambda w: -len(w))[:25]
    rows.append((900, " ".join(rnd.choice(few) for _ in range(250)), "en"))
    got = {r.row.doc_id: r for r in fertility.judge(spark.createDataFrame(
        rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(200))
    r = got[900]
    assert not r.base_failed and not r.kept
    assert r.word_chars / r.n_tokens >= r.by_vocabulary[0].low_chars  # not by the inner band


def test_bands_do_not_depend_on_partitions(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["the", "Tisch", "%%%", "été", "going", "x"]) for _ in range(rnd.randint(50, 90))),
             rnd.choice(["en", "de", None])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, many = (sorted((r.row.doc_id, r.kept, r.by_vocabulary[1].min_chars) for r in fertility.judge(
        docs.repartition(n)).collect()) for n in (1, 7))
    assert [x[:2] for x in one] == [x[:2] for x in many]
    assert np.allclose([x[2] for x in one], [x[2] for x in many])


def test_one_vocabulary_alone(spark):
    docs = spark.createDataFrame([(1, "one two three", "en"), (2, None, None)], "doc_id long, text string, lang string")
    got = fertility.judge(docs, vocabularies=(fertility.PIECE_BPE,), min_words=1).collect()
    assert all("n_tokens_2" not in r.asDict() for r in got)
    assert {r.row.doc_id: r.kept for r in got} == {1: True, 2: False}

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import words as W

TEXTS = ["", None, " ", "a", "a b", "b\ta", "  É漢 x\x0b\x0cy\n", "AbC aBc abc", "x" * 5000, "tail "]


def brute(t, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, t or "")


@pytest.mark.parametrize("table,pattern", [(W.NOT_WHITE, r"[^\x20\x09-\x0D]+"),
                                           (W.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words_and_hashes(monkeypatch, table, pattern):
    rnd = random.Random(1)
    texts = TEXTS + ["".join(rnd.choice("ab é\n.,漢") for _ in range(rnd.randint(0, 50))) for _ in range(200)]
    for piece in (1 << 20, 64):
        monkeypatch.setattr(W, "PIECE", piece)
        monkeypatch.setattr(W, "_POWERS", {})
        words = W.words_of(pa.array(texts, pa.string()), table)
        want = [brute(t, pattern) for t in texts]
        assert words.counts.tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        assert [words.text(i).decode() for i in range(len(flat))] == flat
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in flat]
        seen = {}
        for w, h in zip(lower, words.hashes().tolist()):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_prefixes_are_words_of_that_length():
    words = W.words_of(pa.array(["abcdef abcd abc xyz"]))
    whole, four = W.prefix_hashes(words.data, words.start, words.end, [None, 4])
    assert four[0] == whole[1] == four[1] and four[2] == whole[2]


def test_ngrams_stay_inside_documents():
    words = W.words_of(pa.array(["a b c d", "c d", "", "a b c"]))
    gram, first = W.ngram_hashes(words.hashes(), words.first, 3)
    assert first.tolist() == [0, 2, 2, 2, 3]
    assert gram[0] == gram[2] != gram[1]


def test_slices_bound_the_text():
    batch = pa.record_batch([pa.array(["x" * 10, None, "y" * 30, "", "z" * 5])], names=["text"])
    parts = list(W.text_slices(iter([batch]), "text", 12))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert sum(p.num_rows for p in parts) == 5
    assert list(W.text_slices(iter([batch.slice(0, 0)]), "text")) == []


def test_sliced_and_large_columns():
    col = pa.array(["one two", "three", None, "four five"]).slice(1)
    assert W.words_of(col).counts.tolist() == [1, 0, 2]
    assert W.words_of(col.cast(pa.large_string())).hashes().tolist() == W.words_of(col).hashes().tolist()
    assert np.array_equal(W.per_doc(np.array([1, 0, 1, 1]), np.array([0, 2, 2, 4])), [1, 0, 2])

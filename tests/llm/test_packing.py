import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barsmith.llm import packing
from barsmith.llm.tokens import WORD_BPE, piece_bpe_cache, vocabulary_path, word_bpe_cache
from barsmith.llm.words import words_of

TEXTS = ["", None, "Hello, world!", "don't stop 'em: it's 3.14%", "  ", "ÀÉ été naïve Straße ÷ × 漢字 😀 İ Σας ΣΑΣ",
         "école Å", "<|endoftext|> a<|startoftext|>b", "a b c　d", "x" * 9000,
         "foo--bar's 'sabc ''s re:re", "a_b [c]{d} ~`|", "tab\tnew\nline\x0b\x0c\r end", "same", "same"]


def expected(texts):
    tok = Tokenizer.from_file(vocabulary_path(WORD_BPE))
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_word_cache_equals_the_tokenizer():
    words = words_of(pa.array(TEXTS))
    cache = word_bpe_cache()
    for _ in range(2):
        ids, size = cache.encode_words(words)
        edge = np.concatenate([[0], np.cumsum(size)])[words.first]
        got = [ids[a:b].tolist() + [2] for a, b in zip(edge, edge[1:])]
        assert got == expected(TEXTS)


def test_piece_cache_equals_the_tokenizer_word_by_word():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    texts = ["Hello world été", "漢字 x", ""]
    words = words_of(pa.array(texts))
    ids, size = piece_bpe_cache().encode_words(words)
    assert ids.tolist() == [i for t in texts if t for i in model.encode(t)]


@pytest.mark.parametrize("length", [4, 16, 4096])
def test_round_trip(spark, length):
    random.seed(1)
    texts = TEXTS + [" ".join(random.choice("abc de fgh".split()) for _ in range(random.randint(0, 99)))
                     for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, part string, length int").repartition(5)
    pieces = packing.pack(docs, length=length).collect()
    want = dict(enumerate(expected(texts)))
    got = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = np.frombuffer(p.ids, "<u2").tolist()
        assert len(ids) == p.length > 0 and p.doc_tokens == len(want[p.doc_id])
        assert p.start == len(got.setdefault(p.doc_id, []))
        got[p.doc_id] += ids
    assert got == want
    by_seq = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == by_seq.get(p.sequence_id, 0)
        by_seq[p.sequence_id] = p.offset + p.length
    total = sum(map(len, want.values()))
    assert sorted(by_seq) == list(range(-(-total // length)))
    assert all(by_seq[s] == min(length, total - s * length) for s in by_seq)


def test_crc_and_sequences(spark):
    docs = spark.createDataFrame([(7, "alpha beta"), (8, None), (None, "gamma")], "doc_id long, text string")
    pieces = packing.pack(docs, length=3)
    want = {7: expected(["alpha beta"])[0], 8: [2], None: expected(["gamma"])[0]}
    for p in packing.pack(docs, length=3, crc32=True).collect():
        part = want[p.doc_id][p.start:p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    seqs = sorted(packing.sequences(pieces).collect())
    assert [len(s.ids) // 2 for s in seqs[:-1]] == [3] * (len(seqs) - 1)
    assert sum(len(s.boundaries) for s in seqs) == pieces.count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert packing.pack(docs, crc32=True).count() == packing.pack(docs).count() == 0


def test_texts_are_sent_in_small_slices(spark, monkeypatch):
    """Ids do not depend on the slices, down to one document each."""
    texts = [f"word{i} {'of the ' * (i % 7)}text{i % 5} don't" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(packing, "SEND_BYTES", 1)
    got = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.tokenize(docs).collect()}
    assert got == dict(enumerate(expected(texts)))


def test_new_words_are_merged_into_the_known_ones():
    cache = word_bpe_cache()
    for i in range(0, 3000, 50):
        text = " ".join(f"w{k * 7919 % 3000}" for k in range(i, i + 50)) + " w7 again"
        ids, _ = cache.encode_words(words_of(pa.array([text])))
        assert ids.tolist() + [2] == expected([text])[0]
    assert (cache.known[1:] > cache.known[:-1]).all() and len(cache.known) == len(cache.slot)

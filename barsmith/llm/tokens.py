"""Public tokenizers applied to whole columns, each distinct word once.

Both vocabularies used here never merge across ASCII white space, so the ids
of a text are the ids of its words in order. A column's words are hashed with
numpy, only words not met before by this worker go to the tokenizer library,
and the ids of the column come back as one gather. The table of known words is
dropped when it holds ``MAX_WORDS``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

import numpy as np
import public_tokenizers

from barsmith.llm.words import Words

MAX_WORDS = 600_000
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def vocabulary_path(name: str) -> str:
    return name if os.path.isabs(name) else public_tokenizers.path(name)


class WordCache:
    """Ids of words by word hash: sorted hashes with one id list each."""

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.int32)

    def _learn(self, words: Words, hashes: np.ndarray, at: np.ndarray) -> None:
        found = self.encode([words.text(i).decode("utf-8", "replace") for i in at])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.int32, int(sizes.sum()))
        slots = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(at))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        # Both are in the order of the hashes already: merged, not sorted anew.
        place = np.searchsorted(self.known, hashes[at])
        self.known, self.slot = np.insert(self.known, place, hashes[at]), np.insert(self.slot, place, slots)

    def lookup(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """``(slot of every word, ids per slot are self.ids[begin[s]:begin[s+1]])``."""
        h = words.hashes(lower=False)
        uniq, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        pos = np.searchsorted(self.known, uniq)
        hit = pos < len(self.known)
        hit[hit] = self.known[pos[hit]] == uniq[hit]
        if not hit.all():
            if len(self.known) > MAX_WORDS:
                self.clear()
                hit[:] = False
            self._learn(words, h, at[~hit])
            pos = np.searchsorted(self.known, uniq)
        return self.slot[pos][inverse.reshape(-1)] if len(uniq) else np.empty(0, np.int64), h

    def encode_words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of every word."""
        slot, _ = self.lookup(words)
        begin, size = self.begin[slot], self.begin[slot + 1] - self.begin[slot]
        total = int(size.sum())
        if not total:
            return np.empty(0, np.int32), size
        shift = begin - (np.cumsum(size) - size)
        return self.ids[np.arange(total) + np.repeat(shift, size)], size


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes as printable characters: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Letters whose lower case and composed form are the same by every rule, then
#: any punctuation but the apostrophe (contractions) and "<" (special tokens).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=-@\[-`{-~]*)")


def word_bpe_cache(path: str = WORD_BPE) -> WordCache:
    """Encoder for the lower-cased word BPE. A word of plain letters followed by
    punctuation is at most two pre-tokens, which go straight to the BPE model;
    any other word takes the full tokenizer."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    full = Tokenizer.from_file(vocabulary_path(path))
    model, letters = full.model, _byte_letters()

    def piece(text: str) -> list[int]:
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(letters)
        return [t.id for t in model.tokenize(text)]

    def encode(words: list[str]) -> list[list[int]]:
        out = []
        for w in words:
            m = _PLAIN.fullmatch(w)
            if m:
                a, b = m.groups()
                ids = piece(a.lower()) if a else []
                out.append(ids + piece(b) if b else ids)
            else:
                out.append(full.encode(w, add_special_tokens=False).ids)
        return out

    return WordCache(encode)


def piece_bpe_cache(path: str = PIECE_BPE) -> WordCache:
    """Encoder for the SentencePiece BPE with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(path))
    return WordCache(lambda words: model.encode(words, num_threads=1) if words else [])

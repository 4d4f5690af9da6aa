"""Words and their 64-bit hashes, found in whole Arrow columns with numpy.

A column of texts is handled as its UTF-8 bytes. A 256-entry table says which
bytes belong to words; word starts and ends, prefix sums and hashes are array
operations over all bytes, so there is no Python loop per word or document.
A word's hash depends on its bytes alone: the sum of ``T[byte] * B**i`` modulo
2**64 over its bytes, mixed with its length. ``T`` is a fixed random table.
Words longer than ``PIECE`` bytes get the xxhash of their bytes instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 1 << 18
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
_T = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = int(_rng.integers(1 << 60, 1 << 61)) * 8 + 5
_BINV = pow(_B, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: ASCII white space between words: space, and the control bytes 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WHITE = ~WHITE
#: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of the sequence ``parts[0][i], parts[1][i], ...`` for every i."""
    h = np.full(len(parts[0]), len(parts), np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + p)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if PIECE not in _POWERS:
        with np.errstate(over="ignore"):
            size = PIECE + 1
            _POWERS[PIECE] = tuple(
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, np.uint64(b)))])
                for b in (_B, _BINV))
    p, q = _POWERS[PIECE]
    return p[:n], q[:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offset in them; a
    null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a column in order. ``first[d]:first[d + 1]`` are document d's."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The document number of every word."""
        return np.repeat(np.arange(self.docs), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end, LOWER if lower else None)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and first-run-per-document of the runs of equal non-zero
    (or true) values, cut at document boundaries."""
    n = len(kind)
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[offsets] = True
    cut = np.flatnonzero(change)
    cut = cut if len(cut) and cut[-1] == n else np.append(cut, n)
    own = kind[cut[:-1]] != 0
    start, end = cut[:-1][own], cut[1:][own]
    return start, end, np.searchsorted(start, offsets)


def words_of(col: pa.Array, kinds: np.ndarray = NOT_WHITE) -> Words:
    """Words of every row: maximal runs of bytes of one kind; ``kinds`` is a
    table by byte, and bytes of kind 0 (or false) lie between words."""
    data, offsets = text_buffers(col)
    start, end, first = runs(kinds[data], offsets)
    return Words(data, start, end, first)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                table: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``data[start[i]:end[i]]`` for ascending, non-overlapping spans."""
    return prefix_hashes(data, start, end, [None], table)[0]


def prefix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: list[int | None],
                  table: np.ndarray | None = None) -> np.ndarray:
    """For each of ``sizes`` the hash of the first so many bytes of every span
    (None: of the whole span, which is also a shorter span's prefix)."""
    out = np.empty((len(sizes), len(start)), np.uint64)
    values = _T if table is None else _T[table]
    i = 0
    with np.errstate(over="ignore"):
        while i < len(start):
            base = start[i]
            if end[i] - base > PIECE:
                raw = data[base:end[i]] if table is None else table[data[base:end[i]]]
                for k, size in enumerate(sizes):
                    out[k, i] = xxhash.xxh64_intdigest(raw[:size].tobytes())
                i += 1
                continue
            j = int(np.searchsorted(end, base + PIECE, "right"))
            p, q = _powers(int(end[j - 1] - base))
            c = np.empty(len(p) + 1, np.uint64)
            c[0] = 0
            np.cumsum(values[data[base:end[j - 1]]] * p, out=c[1:])
            s, e = start[i:j] - base, end[i:j] - base
            # An empty span at the very end has no power of its own; its sum is 0.
            inv = q[np.minimum(s, len(q) - 1)] if len(q) else np.ones(len(s), np.uint64)
            for k, size in enumerate(sizes):
                stop = e if size is None else np.minimum(e, s + size)
                out[k, i:j] = mix((c[stop] - c[s]) * inv + (stop - s).astype(np.uint64))
            i = j
    return out


def per_doc(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flag`` between consecutive offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])[offsets])


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``max_bytes`` of text at most, or one
    row. Bounds what numpy holds at once however large Arrow's batches are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size.astype(np.int64))
        i = 0
        while i < batch.num_rows:
            done = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, done + max_bytes, "right")))
            yield batch.slice(i, j - i)
            i = j


def ngram_hashes(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that stay inside a document, and the
    first-gram-per-document offsets."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    gram_first = np.concatenate([[0], np.cumsum(counts)])
    if not gram_first[-1]:
        return np.empty(0, np.uint64), gram_first
    at = np.arange(gram_first[-1]) + np.repeat(first[:-1] - gram_first[:-1], counts)
    return join_hashes([h[at + k] for k in range(n)]), gram_first

"""Operator 7, benchmark decontamination: a prefix-filtered set join.

A benchmark item gives windows of ``size`` consecutive words (one shorter
window if it has fewer words). A window is a set of ``shingle``-word shingles
with positions, and a document holds the window only if it holds all of them,
so the necessary prefix of a window, with its shingles ordered by rarity, is
its rarest shingle. Pass one counts the items' shingles over all documents.
Pass two looks for prefix shingles in every document; each occurrence proposes
a window start, which must satisfy the length and positional bounds (the whole
window lies inside the document) and is then verified word by word.

Benchmark items are taken in blocks of bounded size, each broadcast on its own,
so a benchmark of any size is handled; documents are never shuffled.

Defined results: null and empty texts have no words, so nothing is hit and no
window arises; equal items under several ids all count; a null item id is the
empty string; repeated documents are scanned as often as they come; empty
tables give no rows (documents) or no hits (benchmark); other columns pass
through untouched inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import arrow_map, pieces_for, staged, text_bytes
from barsmith.llm.words import ALNUM, join_hashes, mix, text_slices, words_of

#: UTF-8 bytes of benchmark text in one block.
BLOCK_BYTES = 8 << 20
#: Candidate windows verified at once.
CHUNK = 1 << 18
FILTER_BITS = 22


class Lookup:
    """Positions of hashes in a sorted array; a bit table rules most out first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index into h, index into keys)`` of all matches."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        pos = np.searchsorted(self.keys, h[at])
        ok = pos < len(self.keys)
        ok[ok] = self.keys[pos[ok]] == h[at[ok]]
        return at[ok], pos[ok]


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on (fewer at the end)."""
    padded = np.concatenate([h, np.zeros(width - 1, np.uint64)])
    return mix(join_hashes([padded[k:k + len(h)] for k in range(width)]))


@dataclass
class Windows:
    """Distinct windows of a block of items."""

    words: np.ndarray         # word hashes, one row per window, 0 beyond its length
    length: np.ndarray
    width: np.ndarray         # words per shingle: the shingle size, or a short window's length
    first_item: np.ndarray    # items of window w: item[first_item[w]:first_item[w + 1]]
    item: np.ndarray
    ids: list[str]


def windows_of(ids: list[str], texts: list[str | None], size: int, shingle: int) -> Windows:
    words = words_of(pa.array(texts, pa.large_string()), ALNUM)
    h, rows, lengths, items = words.hashes(), [], [], []
    for i in range(words.docs):
        a, b = words.first[i], words.first[i + 1]
        n = min(size, int(b - a))
        if n:
            grid = h[np.arange(a, b - n + 1)[:, None] + np.arange(n)]
            rows.append(np.pad(grid, ((0, 0), (0, size - n))))
            lengths += [n] * len(grid)
            items += [i] * len(grid)
    grid = np.concatenate(rows) if rows else np.empty((0, size), np.uint64)
    key = np.column_stack([grid, np.array(lengths, np.uint64)])
    uniq, inverse = np.unique(key, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([inverse.reshape(-1), np.array(items, np.int64)]), axis=0)
    length = uniq[:, -1].astype(np.int64)
    return Windows(uniq[:, :-1], length, np.minimum(length, shingle),
                   np.searchsorted(pairs[:, 0], np.arange(len(uniq) + 1)), pairs[:, 1], ids)


def window_shingles(w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(window, position, width, hash)`` of all shingles of all windows."""
    out = []
    for width in np.unique(w.width):
        at = np.flatnonzero(w.width == width)
        for j in range(w.words.shape[1] - width + 1):
            own = at[w.length[at] >= j + width]
            h = mix(join_hashes([w.words[own, j + k] for k in range(width)]))
            out.append((own, np.full(len(own), j), np.full(len(own), width), h))
    return tuple(np.concatenate(x) for x in zip(*out))


def shingle_counts(docs: DataFrame, keys: dict[int, np.ndarray], column: str) -> DataFrame:
    """Pass one: ``(width, pos, n)``, how often each key occurs in all texts."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {width: Lookup(k) for width, k in sent.value.items()}
        totals = {width: np.zeros(len(k), np.int64) for width, k in sent.value.items()}
        for batch in text_slices(batches, column):
            words = words_of(batch.column(column), ALNUM)
            h = words.hashes()
            left = np.repeat(words.first[1:], words.counts) - np.arange(len(h))
            for width, table in tables.items():
                at, pos = table.find(shingles(h, width))
                totals[width] += np.bincount(pos[left[at] >= width], minlength=len(table.keys))
        for width, n in totals.items():
            pos = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pos), width, np.int32)), pa.array(pos), pa.array(n[pos])],
                names=["width", "pos", "n"])

    found = arrow_map(docs.select(F.col(column).cast("string").alias(column)), run,
                      "width int, pos bigint, n bigint")
    return found.groupBy("width", "pos").agg(F.sum("n").alias("n"))


class Prefixes:
    """Windows by their rarest shingle."""

    def __init__(self, w: Windows, counts: dict[int, np.ndarray], keys: dict[int, np.ndarray]):
        window, pos, width, h = window_shingles(w)
        freq = np.empty(len(h), np.int64)
        for k in keys:
            m = width == k
            freq[m] = counts[k][np.searchsorted(keys[k], h[m])]
        order = np.lexsort((pos, h, freq, window))
        lead = order[np.unique(window[order], return_index=True)[1]]
        self.windows, self.tables = w, {}
        for k in keys:
            own = lead[width[lead] == k]
            own = own[np.argsort(h[own], kind="stable")]
            uniq, begin = np.unique(h[own], return_index=True)
            self.tables[k] = (Lookup(uniq), np.append(begin, len(own)), window[own], pos[own])

    def matches(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, window)`` of all verified occurrences in the words ``h``."""
        w, found = self.windows, []
        doc_begin, doc_end = np.repeat(first[:-1], np.diff(first)), np.repeat(first[1:], np.diff(first))
        for width, (table, begin, window, pos) in self.tables.items():
            at, key = table.find(shingles(h, width))
            per = begin[key + 1] - begin[key]
            stop = np.cumsum(per)
            i = 0
            while i < len(at):
                j = max(i + 1, int(np.searchsorted(stop, (stop[i - 1] if i else 0) + CHUNK, "right")))
                n = per[i:j]
                src = np.repeat(np.arange(i, j), n)
                entry = np.repeat(begin[key[i:j]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                start, win = at[src] - pos[entry], window[entry]
                inside = (start >= doc_begin[at[src]]) & (start + w.length[win] <= doc_end[at[src]])
                start, win = start[inside], win[inside]
                for k in range(w.words.shape[1]):
                    here = np.minimum(start + k, len(h) - 1)
                    same = (w.length[win] <= k) | (h[here] == w.words[win, k])
                    start, win = start[same], win[same]
                found.append((start, win))
                i = j
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scan_block(rows: DataFrame, prefixes: Prefixes, column: str) -> DataFrame:
    """Pass two for one block: adds its hits to ``spans`` and ``item_ids``."""
    sent = rows.sparkSession.sparkContext.broadcast(prefixes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        w = p.windows
        for batch in text_slices(batches, "text"):
            words = words_of(batch.column("text"), ALNUM)
            start, win = p.matches(words.hashes(), words.first)
            spans = [list(x or ()) for x in batch.column("spans").to_pylist()]
            items = [set(x or ()) for x in batch.column("item_ids").to_pylist()]
            doc = np.searchsorted(words.first, start, "right") - 1
            edge = np.zeros(len(words.start) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + w.length[win], -1)
            covered = np.cumsum(edge) > 0
            for d, k in np.unique(np.column_stack([doc, win]), axis=0).tolist():
                items[d].update(w.ids[i] for i in w.item[w.first_item[k]:w.first_item[k + 1]])
            for d in np.unique(doc).tolist():
                a, b = words.first[d], words.first[d + 1]
                hit = covered[a:b].copy()
                for old in spans[d]:
                    hit[old["start"]:old["end"]] = True
                bounds = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
                spans[d] = [{"start": s, "end": e} for s, e in bounds.reshape(-1, 2).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(words.counts, pa.int64()),
                 pa.array(spans, pa.list_(SPAN)),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["row", "text", "n_words", "spans", "item_ids"])

    return arrow_map(rows, run, rows.schema)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, shingle: int = 3,
         text: str = "text", item_id: str = "item_id", item_text: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: ``row`` (its columns), ``text``, ``n_words``,
    ``spans`` (hit word ranges, merged) and ``item_ids`` (sorted strings)."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
                             F.col(item_text).cast("string").alias("text"))
    blocks = pieces_for(text_bytes(items), block_bytes)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(text).cast("string").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.array().cast("array<string>").alias("item_ids"))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        w = windows_of([r[0] for r in own], [r[1] for r in own], size, shingle)
        keys, counts = {}, {}
        if len(w.length):
            _, _, width, h = window_shingles(w)
            keys = {int(k): np.unique(h[width == k]) for k in np.unique(width)}
            counts = {k: np.zeros(len(v), np.int64) for k, v in keys.items()}
            for r in shingle_counts(docs, keys, text).collect():
                counts[r["width"]][r["pos"]] = r["n"]
            prefixes = Prefixes(w, counts, keys)
        else:
            prefixes = Prefixes.__new__(Prefixes)
            prefixes.windows, prefixes.tables = w, {}
        rows = _scan_block(rows, prefixes, text)
        if block + 1 < blocks:
            rows = staged(rows, "decontaminate-block")
    return rows


def report(scanned: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all their columns, without the contaminated ones."""
    return scan(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT id, l, array_to_string(w[p:p + l - 1], ' ') AS s FROM (
    SELECT id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
    FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM iw),
dw AS (
  SELECT k, l, p, array_to_string(w[p:p + l - 1], ' ') AS s FROM (
    SELECT k, w, l, unnest(range(1, CAST(len(w) - l + 2 AS BIGINT))) AS p FROM d, lens WHERE len(w) >= l)),
hits AS (SELECT k, dw.l AS l, p, id FROM dw JOIN iw ON dw.l = iw.l AND dw.s = iw.s),
words AS (SELECT k, count(DISTINCT q) AS n FROM (
  SELECT k, unnest(range(p, CAST(p + l AS BIGINT))) AS q FROM hits) GROUP BY k),
ids AS (SELECT k, count(*) AS n, string_agg(id, ',' ORDER BY id) AS s
  FROM (SELECT DISTINCT k, id FROM hits) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.s, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN ids USING (k)
"""

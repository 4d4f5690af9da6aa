"""Operator 9, quality rules: tokeniser fertility.

Public vocabularies measure every whole text: one with byte fallback gives the
share of its byte tokens, and each of them characters per token and the entropy
of the tokens. Rejection bands come from all documents, per language and
vocabulary:

* characters per token: from the lower to the upper quartile, and ``width`` times
  their distance (at least a third of ``floor`` of the median) beyond either;
* entropy: a line in the logarithm of the token count is fitted (longer texts
  have more entropy), and the distance from it is banded in the same way by
  ``line_width``, downwards only (repetition; a quartile distance is at least a
  third of ``line_floor`` bits);
* byte share: the upper quartile and ``width`` quartile distances, at least
  ``byte_margin``;
* a text below the middle on both of the first two, each by more than ``inner``
  median absolute deviations (at least ``floor`` of the median, ``line_floor``
  bits), is rejected too: few characters per token *and* few kinds of
  tokens mark symbol and keyword runs, while either alone is common.

A text is rejected that one of the vocabularies rejects. Quartiles and
medians are exact, of values in steps of ``STEP``: a language's values are counted
by step, so their number is bounded and the result does not depend on partitions
(but for the last digits of the fitted line's sums).

Before that come fixed base rules: at least ``min_words`` words, and at most
``max_repeat_percent`` of words inside a repeated 3-word window.

Defined results: a null or empty text has no words, all counts 0, and fails the
base rules; a null language is a group of its own; repeated rows are judged
alike; an empty table gives no rows; other columns pass through inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import arrow_map, staged
from barsmith.llm.tokens import PIECE_BPE, WORD_BPE, WordCache, piece_bpe_cache, vocabulary_path, word_bpe_cache
from barsmith.llm.words import (
    Words, mix, ngram_hashes, per_doc, runs, span_hashes, text_slices, words_of)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_tokens", "n_byte_tokens"]
VOCABULARIES = (PIECE_BPE, WORD_BPE)
#: Width of the steps in which values are ranked.
STEP = 1e-3
#: Languages whose bands are sent to all tasks; with more, the bands are joined.
MAX_BROADCAST_GROUPS = 10_000
_CACHE: dict[str, tuple] = {}


def _vocabulary(path: str) -> tuple[WordCache, np.ndarray | None]:
    """The encoder, and which ids are byte-fallback tokens (None: it has none)."""
    if path not in _CACHE:
        if path.endswith(".json"):
            _CACHE[path] = (word_bpe_cache(path), None)
        else:
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(path))
            is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
            _CACHE[path] = (piece_bpe_cache(path), is_byte)
    return _CACHE[path]


def columns_of(n: int) -> list[str]:
    """Columns of the ``n``-th vocabulary's measures; the first has plain names."""
    return [c if not n else f"{c}_{n + 1}" for c in ("n_tokens", "n_byte_tokens", "entropy")]


def _names(vocabularies: tuple[str, ...]) -> list[str]:
    return BASE + [c for n in range(len(vocabularies)) for c in columns_of(n)]


def _in_document(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[inverse.reshape(-1)] > 1


def repeat_words(words: Words, h: np.ndarray, width: int = 3) -> np.ndarray:
    """Words per document that lie in a window found twice or more in it."""
    gram, first = ngram_hashes(h, words.first, width)
    doc = np.repeat(np.arange(words.docs), np.diff(first))
    again = np.flatnonzero(repeated(_in_document(gram, doc)))
    at = again + (words.first[:-1] - first[:-1])[doc[again]]
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return per_doc(np.cumsum(edge)[:-1] > 0, words.first)


def duplicate_lines(words: Words, offsets: np.ndarray) -> np.ndarray:
    """Lines per document that hold a word and equal an earlier line of it."""
    start, end, first = runs(words.data != 10, offsets)
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[has_word], end[has_word]
    first = np.concatenate([[0], np.cumsum(has_word)])[first]
    doc = np.repeat(np.arange(words.docs), np.diff(first))
    keys = _in_document(span_hashes(words.data, start, end), doc)
    distinct = np.unique(keys, return_index=True)[1]
    return np.diff(first) - np.bincount(doc[distinct], minlength=words.docs)


def entropies(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Bits of entropy of each document's tokens."""
    n = np.bincount(doc, minlength=docs)
    key, c = np.unique(doc * (1 << 20) + ids, return_counts=True)
    spread = np.bincount(key >> 20, weights=c * np.log2(c), minlength=docs)
    return np.where(n > 0, np.log2(np.maximum(n, 1)) - spread / np.maximum(n, 1), 0.0)


def measure_column(col: pa.Array, vocabularies: tuple[str, ...] = VOCABULARIES) -> list[np.ndarray]:
    """The columns of ``BASE`` for a column of texts, then tokens, byte tokens and
    entropy by each vocabulary."""
    words = words_of(col)
    size = np.array([0 if x is None else x for x in pa.compute.binary_length(col).to_pylist()], np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    in_word = np.zeros(len(words.data) + 1, np.int8)
    in_word[words.start] += 1
    in_word[words.end] -= 1
    letters = (np.cumsum(in_word[:-1], dtype=np.int8) > 0) & ((words.data & 0xC0) != 0x80)
    found = [words.counts, per_doc(letters, offsets), per_doc(SYMBOLS[words.data], offsets),
             duplicate_lines(words, offsets), repeat_words(words, words.hashes(lower=False))]
    for name in vocabularies:
        cache, is_byte = _vocabulary(name)
        ids, n_ids = cache.encode_words(words)
        edge = np.concatenate([[0], np.cumsum(n_ids)])[words.first]
        doc = np.repeat(np.arange(words.docs), np.diff(edge))
        n_bytes = np.zeros(words.docs, np.int64) if is_byte is None else per_doc(is_byte[ids], edge)
        found += [np.diff(edge), n_bytes, entropies(ids, doc, words.docs)]
    return found


def measure(docs: DataFrame, text: str = "text", lang: str = "lang",
            vocabularies: tuple[str, ...] = VOCABULARIES) -> DataFrame:
    """``row`` (the document's columns), ``lang`` and the measures."""
    names = _names(vocabularies)
    kinds = [(c, pa.float64() if c.startswith("entropy") else pa.int64()) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = measure_column(batch.column("text"), vocabularies)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("lang"), *(pa.array(x, k) for x, (_, k) in zip(found, kinds))],
                names=["row", "lang", *names])

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    measures = ", ".join(f"{c} {'double' if k == pa.float64() else 'bigint'}" for c, k in kinds)
    return arrow_map(rows, run, f"row {kind}, lang string, {measures}")


def per_token() -> F.Column:
    """Characters per token; null without tokens."""
    return F.try_divide("word_chars", "n_tokens")


def on_line() -> F.Column:
    """The entropy that the language's line gives for this many tokens."""
    return F.col("slope") * F.log2("n_tokens") + F.col("base")


def bands(measured: DataFrame, width: float, line_width: float, inner: float, floor: float, line_floor: float,
          byte_margin: float) -> DataFrame:
    """One row per language with the bounds, from all rows that have tokens. The
    outer ones lie so many quartile distances beyond the language's quartiles."""
    stepped = lambda c: F.round((F.col(c) if isinstance(c, str) else c) / STEP).cast("bigint")
    middle = lambda c: F.percentile(stepped(c), 0.5) * STEP
    quarter = lambda c: F.transform(F.percentile(stepped(c), [0.25, 0.75]), lambda x: x * STEP)
    own = measured.where("n_tokens > 0")
    share = F.col("n_byte_tokens") / F.col("n_tokens")
    centre = own.groupBy("lang").agg(
        middle(per_token()).alias("mid_chars"), quarter(per_token()).alias("q_chars"), quarter(share).alias("q_bytes"),
        F.coalesce(F.regr_slope("entropy", F.log2("n_tokens")), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("entropy", F.log2("n_tokens")), F.avg("entropy")).alias("base"))
    off = with_bands(own, centre).withColumns({
        "off_chars": F.abs(per_token() - F.col("mid_chars")),
        "off_line": F.abs(F.col("entropy") - on_line())})
    spread = off.groupBy("lang").agg(middle("off_chars").alias("mad_chars"),
                                     middle("off_line").alias("mad_line"),
                                     quarter(F.col("entropy") - on_line()).alias("q_line"))
    one_chars = F.greatest("mad_chars", F.lit(floor) * F.col("mid_chars"))
    one_line = F.greatest("mad_line", F.lit(line_floor))
    far = lambda q, least: F.greatest(F.col(q)[1] - F.col(q)[0], least)
    reach = F.lit(width) * far("q_chars", F.lit(floor / 3) * F.col("mid_chars"))
    line_reach = F.lit(line_width) * far("q_line", F.lit(line_floor / 3)) - F.col("q_line")[0]
    return centre.join(spread.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l"))).select(
        "lang", "slope", "base", (F.col("q_chars")[0] - reach).alias("min_chars"),
        (F.col("q_chars")[1] + reach).alias("max_chars"),
        line_reach.alias("line_reach"),
        (F.col("mid_chars") - F.lit(inner) * one_chars).alias("low_chars"),
        (F.lit(inner) * one_line).alias("low_reach"),
        (F.col("q_bytes")[1] + F.lit(width) * far("q_bytes", F.lit(byte_margin / width))).alias("max_bytes"))


def with_bands(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the bounds of each row's language: sent to all tasks when there are
    few languages, by a shuffle join otherwise."""
    found = found.withColumnRenamed("lang", "_lang")
    few = found.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS
    return rows.join(F.broadcast(found) if few else found,
                     F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", vocabularies: tuple[str, ...] = VOCABULARIES,
          min_words: int = 50, max_repeat_percent: int = 50, width: float = 6.0, line_width: float = 3.0,
          inner: float = 1.2, floor: float = 0.03, line_floor: float = 0.25,
          byte_margin: float = 0.02) -> DataFrame:
    """Measures, bounds (``by_vocabulary``, an array) and verdict of every document."""
    measured = staged(measure(docs, text, lang, vocabularies), "fertility-measures")
    limits = None
    for n in range(len(vocabularies)):
        own = measured.select("lang", "word_chars", *_as_first(n))
        found = bands(own, width, line_width, inner, floor, line_floor, byte_margin)
        found = found.select("lang", F.struct(*[c for c in found.columns if c != "lang"]).alias(f"bounds_{n}"))
        limits = found if limits is None else limits.join(
            found.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")), "full").select(
            F.coalesce("lang", "_l").alias("lang"), *limits.columns[1:], f"bounds_{n}")
    limits = staged(limits.select("lang", F.array(*limits.columns[1:]).alias("by_vocabulary")), "fertility-bands")
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    fits = F.lit(True)
    for n in range(len(vocabularies)):
        inside, low = _verdict(n)
        fits = fits & inside & ~low
    return with_bands(measured, limits).withColumns({
        "base_failed": failed,
        "kept": ~failed & F.coalesce(fits, F.lit(False))})


def _as_first(n: int) -> list[F.Column]:
    """The ``n``-th vocabulary's measures under the names of the first's."""
    return [F.col(c).alias(own) for c, own in zip(columns_of(n), columns_of(0))]


def _verdict(n: int) -> tuple[F.Column, F.Column]:
    """Whether a row is inside the ``n``-th vocabulary's outer bands, and whether it
    is below the middle on both measures."""
    n_tokens, n_bytes, entropy = (F.col(c) for c in columns_of(n))
    bound = lambda c: F.col("by_vocabulary")[n][c]
    chars = F.try_divide("word_chars", n_tokens)
    line = bound("slope") * F.log2(n_tokens) + bound("base")
    inside = ((n_tokens > 0) & chars.between(bound("min_chars"), bound("max_chars"))
              & (entropy >= line - bound("line_reach")) & (F.try_divide(n_bytes, n_tokens) <= bound("max_bytes")))
    return inside, (chars < bound("low_chars")) & (entropy < line - bound("low_reach"))

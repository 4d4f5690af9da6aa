"""Operator 1, quality classifier: importance resampling.

Two generative models over hashed n-grams, one of good text (rows labelled
good) and one of all raw text, are counts in ``2**bits`` buckets. A document's
log importance weight is the sum over its n-grams of log(target / raw). Gumbel
noise, a function of ``doc_id`` and the seed, is added to the weight, and the
``k`` documents with the largest sums are kept: a sample without replacement
in proportion to the weights (Gumbel top-k).

Tokens are runs of letters and digits and runs of other marks, in their own
case; a token equal to the one before it counts as a ditto mark, so stuttering
has n-grams of its own. N-grams are single tokens and pairs.

Counts cover all documents. Labels are used from a bounded sample:
``target_rows`` good and as many bad ids with the smallest hashes. Where ``k`` is not
given it is the number of documents whose weight reaches the cut that best
separates the two labelled samples. The k-th largest sum is found exactly by
histograms that narrow down on it, never by sorting rows in one task.

Defined results: null and empty texts have weight 0; documents whose sums tie
with the k-th are all kept; repeated rows share one noise value; an empty
table gives no rows; without labels of both kinds every document is kept;
other columns pass through inside ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import arrow_groups, arrow_map, drop_staged, staged
from barsmith.llm.words import (ALNUM, NOT_WHITE, join_hashes, text_slices, words_of)

KINDS = NOT_WHITE.astype(np.uint8) + ALNUM
DITTO = np.uint64(0x5DEECE66D)
RANGES = 64


def buckets_of(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every n-gram, the document it is in, and tokens per document."""
    words = words_of(col, KINDS)
    h = words.hashes(lower=False)
    doc = words.doc()
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    h[again] = DITTO
    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(h) else np.empty(0, np.int64)
    grams = np.concatenate([join_hashes([h]), join_hashes([h[pair], h[pair + 1]])])
    return (grams >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([doc, doc[pair]]), words.counts


def labelled_ids(labels: DataFrame, rows: int, label: str = "quality") -> tuple[list, list]:
    """Ids of up to ``rows`` good and bad rows, those with the smallest hashes."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()) \
        .groupBy("doc_id").agg(F.min(label).alias("q"))
    pick = lambda q: [r[0] for r in one.where(F.col("q") == q).orderBy(
        F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(rows).select("doc_id").collect()]
    return pick(1), pick(0)


def ngram_counts(docs: DataFrame, target_ids: list, bits: int, text: str = "text"
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over all documents, and over the target's."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(sorted(target_ids), np.int64))
    width = (1 << bits) // RANGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, total = sent.value, np.zeros((2, 1 << bits), np.int64)
        for batch in text_slices(batches, "text"):
            bucket, doc, _ = buckets_of(batch.column("text"), bits)
            own = np.isin(batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False), ids)
            total[0] += np.bincount(bucket, minlength=1 << bits)
            total[1] += np.bincount(bucket[own[doc]], minlength=1 << bits)
        parts = total.reshape(2, RANGES, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(RANGES), pa.int32()),
             pa.array([parts[:, i].tobytes() for i in range(RANGES)], pa.binary())],
            names=["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in group.column("counts"))
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    schema = "part int, counts binary"
    found = arrow_groups(arrow_map(rows, run, schema), ["part"], add, schema)
    parts = dict((r[0], r[1]) for r in found.collect())
    if not parts:
        return np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    both = np.stack([np.frombuffer(parts[i], np.int64).reshape(2, width) for i in range(RANGES)], 1)
    return both[0].reshape(-1), both[1].reshape(-1)


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log(target / raw) by bucket; the raw model is the prior of the target's.
    Pseudo-counts make up a fifth of the raw counts at most."""
    smoothing = min(smoothing, max(raw.sum(), 1) / (4 * len(raw)))
    p = (raw + smoothing) / (raw.sum() + smoothing * len(raw))
    q = (target + smoothing * len(raw) * p) / (target.sum() + smoothing * len(raw))
    return np.log(q / p)


def score(docs: DataFrame, weights: np.ndarray, seed: int = 0, text: str = "text") -> DataFrame:
    """``row``, ``n_tokens``, ``log_weight`` and ``sum`` (with the noise)."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(math.log2(len(weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            bucket, doc, n = buckets_of(batch.column("text"), bits)
            w = np.bincount(doc, weights=sent.value[bucket], minlength=len(n)) \
                if len(doc) else np.zeros(len(n))
            noise = batch.column("noise").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n, pa.int64()), pa.array(w), pa.array(w + noise)],
                names=["row", "n_tokens", "log_weight", "sum"])

    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       (-F.log(-F.log(uniform))).alias("noise"),
                       F.col(text).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return arrow_map(rows, run, f"row {kind}, n_tokens bigint, log_weight double, sum double")


def kth_largest(df: DataFrame, column: str, k: int, width: int = 4096) -> float:
    """The exact k-th largest value: each round counts the values in ``width``
    equal ranges and goes on in the one that holds the k-th."""
    lo, hi, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return math.inf
    if k >= n:
        return lo
    above, c = 0, F.col(column)
    while lo < hi:
        step = F.least(F.floor((c - lo) / (hi - lo) * width), F.lit(width - 1))
        rows = df.where(c.between(lo, hi)).groupBy(step.alias("b")).agg(
            F.count(F.lit(1)), F.min(c), F.max(c)).orderBy(F.desc("b")).collect()
        for _, count, low, high in rows:
            if above + count >= k:
                lo, hi = low, high
                break
            above += count
    return lo


def best_cut(good: list[float], bad: list[float]) -> float:
    """The weight that best separates the two samples (balanced accuracy), the
    middle of the gap; everything passes where one of them is empty."""
    if not good or not bad:
        return -math.inf
    g, b = np.sort(good), np.sort(bad)
    at = np.unique(np.concatenate([g, b]))
    mid = np.concatenate([[at[0] - 1], (at[1:] + at[:-1]) / 2])
    right = (len(g) - np.searchsorted(g, mid)) / len(g) + np.searchsorted(b, mid) / len(b)
    return float(mid[np.argmax(right)])


def fit(docs: DataFrame, labels: DataFrame, bits: int = 16, target_rows: int = 20_000,
        text: str = "text") -> tuple[np.ndarray, list, list]:
    """Bucket weights, and the ids of the labelled samples."""
    good, bad = labelled_ids(labels, target_rows)
    raw, target = ngram_counts(docs, good, bits, text)
    return log_ratio(raw, target), good, bad


def sample_size(scored: DataFrame, good: list, bad: list, slack: float = 3.0) -> int:
    """How many documents reach the cut between the labelled samples, less
    ``slack``, the reach of the noise."""
    by_id = {**dict.fromkeys(bad, 0), **dict.fromkeys(good, 1)}
    if not good or not bad:
        return scored.count()
    ids = scored.sparkSession.createDataFrame([(int(i), q) for i, q in by_id.items()], "_id long, _q int")
    rows = scored.select(F.col("row.doc_id").cast("bigint").alias("_id"), "log_weight") \
        .join(F.broadcast(ids), "_id").groupBy("_id", "_q").agg(F.first("log_weight")).collect()
    cut = best_cut([r[2] for r in rows if r[1]], [r[2] for r in rows if not r[1]])
    return scored.where(F.col("log_weight") >= cut - slack).count()


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 0,
             bits: int = 16, target_rows: int = 20_000, text: str = "text") -> DataFrame:
    """``row``, ``n_tokens``, ``log_weight``, ``sum`` and ``kept`` of every
    document; ``row`` holds its columns but the text."""
    weights, good, bad = fit(docs, labels, bits, target_rows, text)
    scored = staged(_narrow(score(docs, weights, seed, text), text), "resample-scores")
    k = sample_size(scored, good, bad) if k is None else k
    return scored.withColumn("kept", F.col("sum") >= kth_largest(scored, "sum", k))


def _narrow(scored: DataFrame, text: str) -> DataFrame:
    return scored.withColumn("row", F.col("row").dropFields(text))


def keep(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 0,
         bits: int = 16, target_rows: int = 20_000, text: str = "text") -> DataFrame:
    """The kept documents with all their columns. Scores are a function of the
    row, so the last step scores again in place of storing every text."""
    weights, good, bad = fit(docs, labels, bits, target_rows, text)
    scored = score(docs, weights, seed, text)
    slim = staged(scored.select(F.struct(F.col("row.doc_id").alias("doc_id")).alias("row"),
                                "log_weight", "sum"), "resample-scores")
    k = sample_size(slim, good, bad) if k is None else k
    cut = kth_largest(slim, "sum", k)
    drop_staged(slim)
    return scored.where(F.col("sum") >= cut).select("row.*")

"""Operator 12, ranked lexical search: dense blocked BLAS multiplication.

Items are taken in blocks of bounded bytes. A block's distinct terms are its
compact vocabulary. The first pass finds them in every document and writes a
sparse row per document (its number of terms, the vocabulary terms it holds and
how often) to the shared folder; the corpus figures N, L and df are sums over
that table. The second pass fills dense tiles: integer impacts of a slice of
documents by the vocabulary terms that the slice holds, times the items' integer
term weights. Both are whole numbers in float64. The vocabulary is cut where the
sum of the largest products would reach 2**53, so every partial sum is exact, and
the parts are added as 64-bit integers. Each tile keeps, for every item, its k
best documents; a tile's rows are taken down to the score of the k-th with all
its ties before ids decide. The tasks' lists meet per item in two steps, salted
first, so no item gathers every task's rows at once.

Defined results: a null or empty text has no terms and is neither counted nor
ranked; a null item text gives no rows; every benchmark row is an item of its
own, also where an item id comes twice; rows repeated with one doc_id are ranked
each; a null doc_id comes after all others of its score; an empty table on
either side gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from barsmith.llm.decontaminate import Lookup
from barsmith.llm.staging import arrow_map, pieces_for, staged, text_bytes
from barsmith.llm.words import ALNUM, text_slices, words_of

#: UTF-8 bytes of item text in one block, entries of a dense tile, rows per item.
BLOCK_BYTES, TILE_CELLS, TOP = 1 << 20, 1 << 21, 20
#: Items of one product, and the bound that partial sums stay below.
ITEM_ROWS, EXACT = 256, 1 << 53
#: No impact reaches this.
IMPACT = 1_000_000
NO_ID = np.iinfo(np.int64).max


class Block:
    """The distinct terms of a block of items and the items' counts of them."""

    def __init__(self, texts: list[str | None]):
        words = words_of(pa.array(texts, pa.large_string()), ALNUM)
        self.terms, where = np.unique(words.hashes(), return_inverse=True)
        pairs, n = np.unique(np.column_stack([words.doc(), where.reshape(-1)]), axis=0, return_counts=True)
        self.item, self.term, self.times = pairs[:, 0], pairs[:, 1], n
        self.items = words.docs


# ------------------------------------------------------------ pass one

def term_rows(docs: DataFrame, terms: np.ndarray, text: str, key: str) -> DataFrame:
    """A row per document with terms: ``id``, ``n``, and the vocabulary terms it
    holds (``at``: 32-bit numbers) with their occurrences (``tf``: 64-bit ones);
    and a last row per task with the documents that hold each term (``df``)."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Lookup(sent.value)
        df = np.zeros(len(sent.value), np.int64)
        for batch in text_slices(batches, "body"):
            words = words_of(batch.column("body"), ALNUM)
            at, term = table.find(words.hashes())
            code = words.doc()[at] * len(df) + term
            uniq, tf = np.unique(code, return_counts=True)
            doc, term = uniq // max(len(df), 1), uniq % max(len(df), 1)
            df += np.bincount(term, minlength=len(df))
            rows = np.flatnonzero(words.counts)
            ends = np.searchsorted(doc, np.append(rows, words.docs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), pa.array(words.counts[rows], pa.int64()),
                 pa.array([term[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.array([tf[a:b].astype("<i8").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                 pa.nulls(len(rows), pa.list_(pa.int64()))], names=["id", "n", "at", "tf", "df"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
             pa.array([df.tolist()], pa.list_(pa.int64()))], names=["id", "n", "at", "tf", "df"])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("body"))
    return arrow_map(rows, run, "id bigint, n bigint, at binary, tf binary, df array<bigint>")


def corpus_figures(rows: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and df of a block's terms (one entry per term comes to the driver)."""
    docs, length = rows.where("n IS NOT NULL").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(n_terms, np.int64)
    counts = rows.where("df IS NOT NULL").select(F.posexplode("df").alias("term", "n")) \
        .groupBy("term").agg(F.sum("n").alias("n")).where("n > 0")
    for term, n in counts.collect():
        df[term] = n
    return docs, length or 0, df


def term_weights(docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


# ------------------------------------------------------------ pass two

def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Integer impact of ``tf`` occurrences in a document of ``n`` terms."""
    if 25 * int(n.max(initial=0)) * docs >= 1 << 63:  # beyond 64 bits: whole numbers of any size
        share = np.array([25 * int(x) * docs // length for x in n], np.int64)
    else:
        share = 25 * n * docs // length
    return 1_000_000_000 * tf // (1000 * tf + 12 * (75 + share))


def vocabulary_cuts(most: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of terms whose largest products (``most`` for any item) sum to less
    than 2**53 each."""
    if most.max(initial=0) * IMPACT >= EXACT:
        raise ValueError("one term's weight times its repeats in an item is beyond 2**53 / 10**6")
    cuts, at = [0], 0
    total = np.cumsum(most.astype(object) * IMPACT)
    while len(most) and total[-1] - at >= EXACT:
        cuts.append(int(np.searchsorted(total, at + EXACT, "left")))
        at = total[cuts[-1] - 1]
    return list(zip(cuts, [*cuts[1:], len(most)]))


class Best:
    """The k best ``(score, id)`` per item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.id = np.full((items, k), NO_ID, np.int64)
        self.null = np.zeros((items, k), bool)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores[item, row]`` of the items from ``first`` on. Rows below the
        k-th score, held or in the tile, cannot matter; its ties can."""
        items, rows = scores.shape
        least = np.maximum(self.score[first:first + items, -1], 1)
        if rows > self.k:
            least = np.maximum(least, np.partition(scores, rows - self.k, axis=1)[:, rows - self.k])
        hit_item, hit_row = np.nonzero(scores >= least[:, None])
        if not len(hit_item):
            return
        touched = np.unique(hit_item)
        held = np.repeat(touched, self.k)
        item = np.concatenate([held, hit_item])
        score = np.concatenate([self.score[first + touched].reshape(-1), scores[hit_item, hit_row]])
        id_ = np.concatenate([self.id[first + touched].reshape(-1), ids[hit_row]])
        gone = np.concatenate([self.null[first + touched].reshape(-1), null[hit_row]])
        order = np.lexsort([id_, gone, -score, item])
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        keep = order[place < self.k]
        for held, new in ((self.score, score), (self.id, id_), (self.null, gone)):
            held[first + touched] = new[keep].reshape(len(touched), self.k)


def tile_scores(weights: np.ndarray, rows: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int,
                cuts: list[tuple[int, int]]) -> np.ndarray:
    """``items x rows`` scores: dense weights times dense impacts, a vocabulary
    range at a time, each product exact in float64."""
    out = np.zeros((len(weights), n_rows), np.int64)
    for a, b in cuts:
        own = (term >= a) & (term < b)
        used, column = np.unique(term[own], return_inverse=True)
        if len(used):
            tile = np.zeros((len(used), n_rows))
            tile[column.reshape(-1), rows[own]] = impact[own]
            out += (weights[:, used].astype(np.float64) @ tile).astype(np.int64)
    return out


def best_rows(rows: DataFrame, block: Block, docs: int, length: int, w: np.ndarray, k: int) -> DataFrame:
    """``item`` (its number in the block), ``score`` and ``id``: each task's best."""
    sent = rows.sparkSession.sparkContext.broadcast((block, w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = sent.value
        best = Best(block.items, k)
        most = np.zeros(len(w), np.int64)
        np.maximum.at(most, block.term, block.times * w[block.term])
        cuts = vocabulary_cuts(most)
        each = max(1, TILE_CELLS // max(len(w), ITEM_ROWS))
        dense: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, each):
                batch = whole.slice(at, each)
                n = batch.column("n").to_numpy()
                sizes = pc.binary_length(batch.column("at")).to_numpy() // 4
                row = np.repeat(np.arange(len(n)), sizes)
                term = np.frombuffer(b"".join(batch.column("at").to_pylist()), "<i4").astype(np.int64)
                tf = np.frombuffer(b"".join(batch.column("tf").to_pylist()), "<i8").astype(np.int64)
                impact = impacts(tf, n[row], docs, length)
                ids = batch.column("id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                number = ids.fill_null(NO_ID).to_numpy()
                for first in range(0, block.items, ITEM_ROWS):
                    some = min(ITEM_ROWS, block.items - first)
                    if first not in dense:
                        weights = np.zeros((some, len(w)), np.int64)
                        own = (block.item >= first) & (block.item < first + some)
                        weights[block.item[own] - first, block.term[own]] = \
                            block.times[own] * w[block.term[own]]
                        dense = {first: weights} if block.items > 4 * ITEM_ROWS else dense | {first: weights}
                    best.add(first, tile_scores(dense[first], row, term, impact, len(n), cuts), number, null)
        item, place = np.nonzero(best.score > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(best.score[item, place]),
             pa.array(best.id[item, place], mask=best.null[item, place])], names=["item", "score", "id"])

    return arrow_map(rows.where("n IS NOT NULL").select("id", "n", "at", "tf"), run, "item int, score bigint, id bigint")


def top_per_item(found: DataFrame, k: int, parts: int) -> DataFrame:
    """The k best of every item: first among the tasks of one salt, then among
    the salts, so that one item's rows never all go to one task at once."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]

    def best(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.select("*", rank.alias("rank")).where(F.col("rank") <= k)

    salt = F.pmod(F.xxhash64("id"), F.lit(max(1, math.isqrt(parts))))
    return best(best(found.select("*", salt.alias("salt")), "item", "salt").drop("rank"), "item").drop("salt")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", key: str = "doc_id",
           item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The ``k`` documents of highest score above 0 for every item: the item's
    id, ``rank``, the document's id and ``score``."""
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType
    kept = staged(items.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text")),
                  "search-items")
    n = pieces_for(text_bytes(kept), BLOCK_BYTES)
    parts: list[DataFrame] = []
    for i in range(n):
        block_rows = kept.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) \
            .orderBy(F.col("item_id").asc_nulls_last(), "text").collect()
        block = Block([r.text for r in block_rows])
        if not len(block.terms):
            continue
        rows = staged(term_rows(docs, block.terms, text, key), "search-terms")
        total, length, df = corpus_figures(rows, len(block.terms))
        if not total:
            continue
        best = best_rows(rows, block, total, length, term_weights(total, df), k)
        ids = spark.createDataFrame([(j, r.item_id) for j, r in enumerate(block_rows)],
                                    f"item int, item_id {kind.simpleString()}")
        top = top_per_item(best, k, rows.rdd.getNumPartitions()) if n == 1 \
            else staged(top_per_item(best, k, rows.rdd.getNumPartitions()), "search-best")
        parts.append(top.join(F.broadcast(ids), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS i, item_id,
  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
n AS (SELECT k, doc_id, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
tf AS (SELECT k, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, c GROUP BY term, docs),
p AS (SELECT k, doc_id, 75 + (25 * n * docs) // length AS m FROM n, c),
s AS (SELECT i, item_id, k, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN p USING (k) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""

"""Operator 13, filter interaction audit: Lehmer-rank difference arrays.

Filters A to E can be applied in any order, and a document goes at the first
filter that it fails. What an order does to a document depends only on its
mask, the set of filters it fails, so the documents are first counted by part
and mask. For one mask, the orders in which it goes at step s by a given filter
start with s - 1 filters that it passes and then that one; orders that share a
beginning are a contiguous interval of lexicographic ranks (the Lehmer digits of
the beginning give its first rank). A mask's counts are added at the first rank
of each such interval and taken off after its last; one prefix sum over all
ranks gives the removals of every step of every order. The rest follows: what is
left after a step, failures that an earlier step had removed, and the Shapley
sums over all orders.

Filter E (the text equals that of a smaller id) needs the whole table: narrow
rows of two text hashes, id, part and mask meet by (hashes, id) with the least id
of each text, after rows equal in all of these became one row with a count, so a
text with any number of copies is one row per copy's id and no group is listed.

Defined results: a null text is an empty one, a null source the part ''; a null
id is smaller than no id and no id is smaller than it, so it never fails E and
has no labels; rows repeated with one id are counted each and do not fail E
through each other; several label rows of one id count as marked if one of them
is; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barsmith.llm.staging import arrow_map, staged

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 50, 65, 5
#: What is counted: all documents, good ones, toxic ones.
KINDS = ["n", "good", "toxic"]
#: Parts whose arrays are held at once.
PARTS = 256


# ------------------------------------------------------------ the filters

def words(text: Column) -> Column:
    """Maximal runs of anything but white space (space and the bytes 9 to 13)."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def base_mask(body: str, words_column: str) -> Column:
    """Filters A to D as bits 0 to 3, of columns with the text and its words."""
    text, n = F.col(body), F.size(words_column)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < MIN_WORDS, 100 * F.size(F.array_distinct(words_column)) < MIN_DISTINCT * n,
             100 * upper > MAX_UPPER * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
             part: str = "source") -> DataFrame:
    """``part``, ``mask`` and the counts of documents, good and toxic ones."""
    body = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    split = body.select("*", words(F.col("body")).alias("words"))
    rows = staged(split.select(
        "id", "part", F.xxhash64("body", F.lit(1)).alias("k1"), F.xxhash64(F.lit(2), "body").alias("k2"),
        base_mask("body", "words").alias("mask"))
        .groupBy("id", "part", "k1", "k2", "mask").agg(F.count(F.lit(1)).alias("n")), "filter-rows")
    first = rows.where("id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("id")) \
        .select("*", F.lit(True).alias("first"))
    marks = labels.select(F.col(key).cast("bigint").alias("id"),
                          *[F.coalesce(F.col(c) == 1, F.lit(False)).cast("int").alias(k)
                            for c, k in (("quality", "good"), ("toxic", "toxic"))]) \
        .groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    late = F.col("id").isNotNull() & F.col("first").isNull()
    found = rows.join(first, ["k1", "k2", "id"], "left").join(marks, "id", "left")
    mark = {k: F.sum(F.col("n") * F.coalesce(k, F.lit(0))).alias(k) for k in KINDS[1:]}
    return found.select("part", "n", "good", "toxic", (F.col("mask") + F.when(late, 16).otherwise(0)).alias("mask")) \
        .groupBy("part", "mask").agg(F.sum("n").alias("n"), *mark.values())


# ------------------------------------------------------------ the ranks

def rank_interval(start: tuple[int, ...], size: int) -> tuple[int, int]:
    """Ranks ``[low, high)`` of the permutations of ``range(size)`` that begin
    with ``start``, by its Lehmer digits."""
    low = sum(sum(x < a and x not in start[:i] for x in range(size)) * factorial(size - 1 - i)
              for i, a in enumerate(start))
    return low, low + factorial(size - len(start))


def removal_ends(size: int) -> np.ndarray:
    """Rows ``(mask, step, rank, sign)``: where the intervals of orders in which
    documents of a mask go at a step begin (1) and end (-1)."""
    out = []
    for step in range(size):
        for start in permutations(range(size), step + 1):
            low, high = rank_interval(start, size)
            passed = sum(1 << f for f in start[:step])
            for mask in range(1 << size):
                if not mask & passed and mask >> start[step] & 1:
                    out += [(mask, step, low, 1), (mask, step, high, -1)]
    return np.array(out, np.int64)


def audit_arrays(counts: np.ndarray, ends: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """All totals of a batch of parts from ``counts[part, mask, kind]``; arrays
    by part, order and step (``orders[order, step]`` is the filter there)."""
    parts, masks, kinds = counts.shape
    ranks, size = orders.shape
    change = np.zeros((ranks + 1, size, parts, kinds), np.int64)
    mask, step, rank, sign = ends.T
    np.add.at(change, (rank, step), np.moveaxis(counts, 1, 0)[mask] * sign[:, None, None])
    removed = np.moveaxis(np.cumsum(change[:-1], axis=0), 2, 0)     # part, order, step, kind
    gone = removed[..., 0]
    has = (np.arange(masks)[:, None] >> np.arange(size)) & 1
    failing = counts[..., 0] @ has                                  # part, filter
    alone = counts[:, 1 << np.arange(size), 0]
    by_filter = np.zeros((parts, size), np.int64)
    np.add.at(by_filter, (slice(None), orders), gone)
    return {"kept": counts[..., 0].sum(1)[:, None, None] - np.cumsum(gone, axis=2), "removed": gone,
            "redundant": failing[:, orders] - gone, "unique_fails": alone[:, orders],
            "good_lost": removed[..., 1], "toxic_lost": removed[..., 2], "shapley": by_filter[:, orders]}


TOTALS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts by part and mask to a row per part, order and step. A part is one
    row of at most ``2 ** len(filters)`` entries before its arrays are made."""
    packed = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *KINDS)).alias("masks"))
    size = len(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = removal_ends(size)
        orders = np.array(list(permutations(range(size))), np.int64)
        names = pa.array(["".join(filters[i] for i in o) for o in orders])
        for whole in batches:
            for at in range(0, whole.num_rows, PARTS):
                batch = whole.slice(at, PARTS)
                masks = batch.column("masks")
                n, flat = batch.num_rows, masks.flatten()
                row = np.repeat(np.arange(n), masks.value_lengths().to_numpy(zero_copy_only=False))
                each = np.zeros((n, 1 << size, len(KINDS)), np.int64)
                for k, kind in enumerate(KINDS):
                    each[row, flat.field("mask").to_numpy(), k] = flat.field(kind).to_numpy()
                found = audit_arrays(each, ends, orders)
                length = orders.size
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").take(pa.array(np.repeat(np.arange(n), length))),
                     names.take(pa.array(np.tile(np.repeat(np.arange(len(orders)), size), n))),
                     pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), n * len(orders))),
                     *[pa.array(found[c].reshape(-1)) for c in TOTALS]],
                    names=["part", "filter_order", "step", *TOTALS])

    return arrow_map(packed, run, "part string, filter_order string, step int, "
                     + ", ".join(f"{c} bigint" for c in TOTALS))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM w LEFT JOIN lab USING (doc_id)),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
g AS (SELECT part, list_filter([CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
  CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END], lambda y: y IS NOT NULL) AS mask,
  count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
o AS (SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order,
  [f1.x, f2.x, f3.x, f4.x, f5.x] AS fs
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE len(list_distinct([f1.x, f2.x, f3.x, f4.x, f5.x])) = 5),
s AS (SELECT filter_order, fs, unnest([1, 2, 3, 4, 5]) AS step FROM o),
x AS (SELECT part, filter_order, step, fs[step] AS flt, n, good, toxic, mask,
  list_contains(mask, fs[step]) AS bad, len(list_intersect(mask, fs[:step - 1])) > 0 AS before FROM s, g),
r AS (SELECT part, filter_order, step, flt,
  sum(CASE WHEN NOT bad AND NOT before THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN bad AND NOT before THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN bad AND before THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN bad AND len(mask) = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN bad AND NOT before THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN bad AND NOT before THEN toxic ELSE 0 END) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, flt) AS BIGINT) AS shapley FROM r
"""

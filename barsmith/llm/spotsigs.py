"""Operator 11, document fingerprints: SpotSigs (DataFrame functions only).

A spot signature is a common-word anchor and the chain of the next ``CHAIN``
content words (words that are no anchors) after it; of a run of anchors the last
one counts. A document's fingerprint is the sorted set of its signatures' hashes
(60 bits of MD5). Two fingerprints are compared by the Jaccard measure of their
sets, pruned by set length: sets fall into partitions whose lengths differ by a
factor of ``1 / FLOOR``, sets further apart than neighbouring partitions, or whose
lengths alone keep the measure below ``FLOOR``, count as unlike (0) without being
compared, and equal sets as alike (1); the others are intersected.

``edited_pairs`` gives every document an edited text, whose last quarter is the
beginning of the next document by id. The order comes from narrow rows (id, text
hash, length) in id ranges. Only a prefix and the signatures of a document go to
its predecessor; the texts are dealt out once, by id.

Defined results: words are maximal runs of ASCII letters and digits and non-ASCII
characters, lower-cased; a null text is an empty one. A text without a spot has one
signature, of its whole text, so no set is empty and equal texts alone share that
one. Equal texts have equal fingerprints. A null id comes before all others. Rows
with one id are ordered by their text's hash; repeated rows (same id and text) are
treated alike, each with the next different row. A single row is its own next. An
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barsmith.llm.staging import staged
from barsmith.session import shuffle_width

#: Common words of English, German, French and Spanish.
ANCHORS = {
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au".split(),
    "es": "de la que el en y los se del las un por con no su una para es al lo".split(),
}
CHAIN, FLOOR = 3, 0.05
DIGITS = 15
FIRST_ID = -(1 << 63)


def anchor_words() -> list[str]:
    return sorted({w for words in ANCHORS.values() for w in words})


def with_signatures(rows: DataFrame, texts: dict[str, str], chain: int = CHAIN,
                    anchors: list[str] | None = None) -> DataFrame:
    """Adds a column ``name`` with the sorted signature hashes of the text column,
    for every ``name: text column``. Each step is a projection of its own, so that
    no array is built anew per word."""
    anchors = anchors or anchor_words()
    names = list(texts)
    rows = rows.select("*", *[F.array_remove(F.split(F.lower(texts[n]), "[\\x00-/:-`{-\\x7f]+"), "").alias(f"_w_{n}")
                              for n in names])
    rows = rows.select("*", *[F.transform(f"_w_{n}", lambda w: w.isin(anchors)).alias(f"_a_{n}") for n in names])
    # Positions of the content words.
    rows = rows.select("*", *[F.array_compact(F.transform(
        f"_a_{n}", lambda a, i: F.when(~a, i))).alias(f"_c_{n}") for n in names])

    def spot(n: str):
        word = lambda i: F.get(f"_w_{n}", i)
        places = [lambda p, k, j=j: F.get(f"_c_{n}", k + F.lit(j)) for j in range(chain)]
        return lambda p, k: F.when(
            (p > 0) & F.get(f"_a_{n}", p - 1) & (k + F.lit(chain) <= F.size(f"_c_{n}")),
            _hash(F.concat_ws(" ", word(p - 1), *[word(at(p, k)) for at in places])))

    rows = rows.select("*", *[F.sort_array(F.array_distinct(F.array_compact(F.transform(f"_c_{n}", spot(n)))))
                              .alias(f"_s_{n}") for n in names])
    drop = [f"_{x}_{n}" for x in "wacs" for n in names]
    return rows.select("*", *[F.when(F.size(f"_s_{n}") > 0, F.col(f"_s_{n}"))
                              .otherwise(F.array(_hash(F.concat(F.lit("\n"), F.col(texts[n]))))).alias(n)
                              for n in names]).drop(*drop)


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("bigint")


def fingerprint(signatures: str) -> Column:
    """The set as text: every hash in hexadecimal, in order."""
    return F.array_join(F.transform(signatures, lambda x: F.lower(F.lpad(F.hex(x), DIGITS, "0"))), "")


def length_partition(size: Column, floor: float = FLOOR) -> Column:
    """Sets of Jaccard measure ``floor`` or more lie in the same partition of set
    lengths or in neighbouring ones."""
    return F.floor(F.log(size) / F.log(F.lit(1 / floor)))


def likeness(a: str, b: str, floor: float = FLOOR) -> Column:
    """Pruned Jaccard measure of two signature sets."""
    n, m = F.size(a), F.size(b)
    apart = (F.abs(length_partition(n, floor) - length_partition(m, floor)) > 1) \
        | (F.least(n, m) < F.lit(floor) * F.greatest(n, m))
    both = F.size(F.array_intersect(a, b))
    return F.when(F.col(a) == F.col(b), 1.0).when(apart, 0.0).otherwise(both / (n + m - both))


# ------------------------------------------------------------ the next document

def predecessors(rows: DataFrame) -> DataFrame:
    """For every distinct ``(id, h)`` of ``rows (id, h, n)`` the one before it in
    that order, cyclically, and its ``n``: ``to_id``, ``to_h``, ``to_n``."""
    spark = rows.sparkSession
    width = shuffle_width(spark)
    ranged = staged(rows.groupBy("id", "h").agg(F.max("n").alias("n")).repartitionByRange(width, "id", "h")
                    .select("*", F.spark_partition_id().alias("range")), "document-order")
    here = F.struct("id", "h", "n")
    # One entry per range: the last row of the range before it (of the last, for the first).
    last = {r["range"]: r["e"] for r in ranged.groupBy("range").agg(F.max(here).alias("e")).collect()}
    order = sorted(last)
    entry = "range int, e_id bigint, e_h bigint, e_n int"
    ends = spark.createDataFrame([(k, *last[order[i - 1]]) for i, k in enumerate(order)], entry)
    before = F.lag(here).over(Window.partitionBy("range").orderBy("id", "h"))
    linked = ranged.select("*", before.alias("b")).join(F.broadcast(ends), "range")
    return linked.select("id", "h", *[F.when(F.col("b").isNull(), F.col(f"e_{c}")).otherwise(F.col(f"b.{c}"))
                                      .alias(f"to_{c}") for c in ("id", "h", "n")])


def edited_pairs(docs: DataFrame, text: str = "text", key: str = "doc_id", chain: int = CHAIN,
                 floor: float = FLOOR) -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited`` (its edited text), the signature
    sets ``own``, ``other`` (of the edited text) and ``next``, and the likeness of
    its own to these, ``near_edited`` and ``near_next``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(FIRST_ID)).alias("id"),
                        F.xxhash64(body).alias("h"), body.alias("body"))
    links = staged(predecessors(keyed.select("id", "h", F.length("body").alias("n"))), "document-links")
    # To the predecessor: as much of the text as replaces its end, and the signatures.
    sent = keyed.join(links, ["id", "h"]).select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), "body",
        F.expr("substring(body, 1, to_n div 4)").alias("head"))
    sent = with_signatures(sent, {"next": "body"}, chain).select("id", "h", F.struct("head", "next").alias("s")) \
        .groupBy("id", "h").agg(F.first("s").alias("s"))
    pairs = keyed.join(sent, ["id", "h"]).select(
        F.expr(f"nullif(id, {FIRST_ID})").alias("doc_id"), "body", F.length("body").alias("n_chars"),
        F.concat(F.expr("substring(body, 1, length(body) - length(body) div 4)"), F.col("s.head")).alias("edited"),
        F.col("s.next").alias("next"))
    return with_signatures(pairs, {"own": "body", "other": "edited"}, chain).select(
        "doc_id", "n_chars", "edited", "own", "other", "next", likeness("own", "other", floor).alias("near_edited"),
        likeness("own", "next", floor).alias("near_next"))


def _oracle_set(text: str) -> str:
    """SQL for the sorted signatures of a text column, as fixed-width digits."""
    words = f"list_filter(regexp_extract_all(lower({text}), '[^\\x00-/:-`{{-\\x7f]+'), lambda x: x <> '')"
    return f"""(SELECT CASE WHEN len(s) > 0 THEN s ELSE [substr(md5(chr(10) || {text}), 1, {DIGITS})] END
      FROM (SELECT list_sort(list_distinct(list_filter(list_transform(range(1, len(c) + 1), lambda k:
        CASE WHEN c[k] > 1 AND a[c[k] - 1] AND k + {CHAIN - 1} <= len(c) THEN substr(md5(
          concat_ws(' ', w[c[k] - 1], {', '.join(f'w[c[k + {j}]]' for j in range(CHAIN))})), 1, {DIGITS}) END),
        lambda x: x IS NOT NULL))) AS s
      FROM (SELECT w, a, list_filter(range(1, len(w) + 1), lambda i: NOT a[i]) AS c
      FROM (SELECT w, list_transform(w, lambda x: list_contains(anchors, x)) AS a FROM (SELECT {words} AS w)))))"""


def _oracle_near(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    part = lambda x: f"floor(ln(len({x})) / ln(CAST({1 / FLOOR} AS DOUBLE)))"
    return f"""CASE WHEN {a} = {b} THEN CAST(1 AS DOUBLE)
      WHEN abs({part(a)} - {part(b)}) > 1 OR least(len({a}), len({b})) < CAST({FLOOR} AS DOUBLE) * greatest(len({a}), len({b}))
      THEN CAST(0 AS DOUBLE) ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
n AS (SELECT *, coalesce(lead(body) OVER (ORDER BY doc_id NULLS FIRST),
  first_value(body) OVER (ORDER BY doc_id NULLS FIRST)) AS follow FROM d),
e AS (SELECT *, body[:length(body) - length(body) // 4] || follow[:length(body) // 4] AS edited,
  [{', '.join(repr(w) for w in anchor_words())}] AS anchors FROM n),
s AS (SELECT doc_id, body, edited, {_oracle_set('body')} AS own, {_oracle_set('edited')} AS other,
  {_oracle_set('follow')} AS next FROM e)
SELECT doc_id, CAST(length(body) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(own, '') AS fingerprint, array_to_string(other, '') AS edited_fingerprint,
  {_oracle_near('own', 'other')} AS near_edited, {_oracle_near('own', 'next')} AS near_next FROM s
"""

"""Operator 2, line dedup by distinct-site spread (DataFrame functions only).

Every line is hashed. One aggregation merges, per line hash, HyperLogLog
sketches of the sites it occurs on, so a line's state is of fixed size however
often it occurs. Lines whose estimate is far above ``min_sites`` are cross-site
boilerplate, those far below are not, and only those within ``margin`` of it
have their sites counted exactly.

Boilerplate lines are removed from every document, except from copies, which are
left to near-duplicate removal: a text that several documents hold, and one of
which nothing would be left. Found positions are gathered per distinct text (two
64-bit hashes), so many copies of one text cost one row; how often each position
was found says how many documents hold the text. With ``spare=False`` nothing is
left to a later step: copies lose their boilerplate lines too, and a text of such
lines alone becomes what blank lines it has, or empty.

Lines are compared without white space at their ends; lines of white space
alone never count. Defined results: a null or empty text stays as it is; a null
site is a site of its own; repeated rows are treated alike; an empty table
gives no rows; all columns of the input stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import staged

WHITE = " \t\r\x0b\x0c"
MIN_SITES, MARGIN, LG_K = 8, 0.25, 10


def lines_of(docs: DataFrame, text: str, site: str) -> DataFrame:
    """A row per line that holds more than white space: the text's two hashes,
    position, line hash, characters and site."""
    body = F.col(text).cast("string")
    # A text is hashed once: in the projection of the explode it would be per line.
    keyed = docs.select(
        F.xxhash64(body, F.lit(1)).alias("k1"), F.xxhash64(F.lit(2), body).alias("k2"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.split(body, "\n", -1).alias("parts"))
    each = keyed.select("k1", "k2", "site", F.posexplode("parts").alias("pos", "line"))
    line = F.btrim("line", F.lit(WHITE))
    return each.where(line != "").select("k1", "k2", "site", "pos", F.xxhash64(line).alias("line"),
                                         F.length(line).alias("chars"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN,
                lg_k: int = LG_K) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` distinct sites."""
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    likely = staged(spread.where(F.col("sites") >= (1 - margin) * min_sites), "line-spread")
    near = likely.where(F.col("sites") <= (1 + margin) * min_sites).select("line")
    exact = lines.select("line", "site").join(near, "line", "left_semi").distinct() \
        .groupBy("line").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    return likely.where(F.col("sites") > (1 + margin) * min_sites).select("line") \
        .unionByName(exact.select("line"))


def clean(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
          margin: float = MARGIN, spare: bool = True) -> DataFrame:
    """``row`` (the document's columns), the cleaned ``text``, ``n_lines`` and
    ``n_removed``; copies are cut like any other text unless ``spare``."""
    lines = lines_of(docs, text, site)
    spread = staged(boilerplate(lines, min_sites, margin), "boilerplate-lines")
    # Each document of a text brings each of the text's hits once.
    hits = lines.join(spread, "line", "left_semi").groupBy("k1", "k2", "pos", "chars").agg(
        F.count(F.lit(1)).alias("n")).groupBy("k1", "k2").agg(
        F.collect_list("pos").alias("gone"), F.sum("chars").alias("found"), F.max("n").alias("copies"))
    hits = staged(hits.where("copies = 1") if spare else hits, "boilerplate-hits")
    body = F.col(text).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       body.alias("text"), F.xxhash64(body, F.lit(1)).alias("k1"),
                       F.xxhash64(F.lit(2), body).alias("k2")) \
        .join(hits.hint("merge"), ["k1", "k2"], "left")  # one plan at every size; skew is split at run time
    rows = rows.select("row", "text", "found", "gone", F.split("text", "\n", -1).alias("parts"))
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, x: a + F.length(F.btrim(x, F.lit(WHITE))))
    gone = F.when(F.col("found") < total, F.col("gone")) if spare else F.col("gone")
    rows = rows.select("row", "text", "parts", gone.alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    rows = rows.select("row", "text", "parts", "gone", F.when(F.col("gone").isNotNull(), left).alias("left"))
    return rows.select(
        "row", F.when(F.col("gone").isNotNull(), F.array_join(
            F.transform("left", lambda i: F.get("parts", i)), "\n")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, text, string_split(text, chr(10)) AS ls
  FROM documents),
l AS (SELECT k, coalesce(source, '') AS site, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
n AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM l),
b AS (SELECT t FROM n WHERE t <> '' GROUP BY t HAVING count(DISTINCT site) >= {MIN_SITES}),
f AS (SELECT n.*, b.t IS NOT NULL AS hit FROM n LEFT JOIN b USING (t)),
p AS (SELECT text, count(*) AS copies FROM documents GROUP BY text),
s AS (SELECT k, max(copies) = 1 AND sum(CASE WHEN hit THEN length(t) ELSE 0 END) < sum(length(t)) AS cut
  FROM f JOIN d USING (k) JOIN p USING (text) GROUP BY k),
c AS (SELECT k, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT (hit AND cut)) AS t,
  count(*) AS n_lines, count(*) FILTER (hit AND cut) AS n_removed FROM f JOIN s USING (k) GROUP BY k)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(c.t, '') END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM d LEFT JOIN c USING (k)
"""

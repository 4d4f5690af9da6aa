"""Operator 6, n-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its five-word shingles. Two documents link if
100 * |A & B| >= 80 * |A | B|, so |A & B| is at least 4 (|A| + |B|) / 9, and at
least T = ceil(0.8 |A|).

1. One pass over the texts sends every distinct shingle of a document to the
   bucket of its hash. Equal sets are one class from here on (a class is known
   by a digest of its set), so copies are never compared or listed in pairs.
2. A bucket holds the inverted lists of its shingles. A shingle of one class
   only can link nothing and ends here; the others return, with the length of
   their list, to their classes. A class with fewer than T of them has no links.
3. With shingles ordered by list length (rarest first), linked classes share
   one of their first n - T + 1. Classes that share such a shingle are joined
   to families, which no link leaves.
4. Within a family, each class asks the inverted lists of the family for the
   classes that occur at least T times in the lists of its own shingles. The
   short lists are merged, by a heap or, where they are many, by one sort; a
   class must occur T - L times there. The L longest lists are never read
   through: the candidates that remain are probed in them by binary search.
   Candidates already connected to the asking class are skipped, so a family
   of near copies costs a few searches per member rather than all pairs.
   A family above ``family_limit`` classes is cut into shards, and every pair
   of shards is searched as a task of its own.

The result is exact up to collisions of 64-bit hashes (of words, shingles and
sets). No cap, sample or limit drops a candidate.

Defined results: null and empty texts, and texts of white space alone, have
no shingles and link with nothing; a text of fewer than five words is one
shingle; repeated rows are members of one class; a null id never names a
component; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barsmith.llm.components import components
from barsmith.llm.staging import arrow_groups, arrow_map, pieces_for, staged, text_bytes
from barsmith.llm.words import join_hashes, mix, ngram_hashes, text_slices, words_of

WIDTH, PERCENT = 5, 80
#: Text bytes per bucket of shingles: some four million shingles to sort. Every
#: class costs 16 bytes in each bucket it has shingles in, so larger buckets
#: shuffle less; ``LEAST_BUCKETS`` keep a small input parallel.
BUCKET_BYTES = 24 << 20
LEAST_BUCKETS = 16
#: Text bytes hashed at once; equal sets in a slice are sent once.
SEND_BYTES = 4 << 20
#: Bytes of shingles searched in one task, and classes searched in one shard.
FAMILY_BYTES = 24 << 20
FAMILY_LIMIT = 2048
#: Weight of the list length in the choice of the number of long lists.
MU = 0.01
HEAP_LIMIT = 256


def least_overlap(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Overlap that any link of a set of ``n`` shingles needs: ceil(p n)."""
    return -(-percent * n // 100)


def shingle_sets(col: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, and the first-per-document offsets."""
    words = words_of(col)
    h = words.hashes()
    gram, first = ngram_hashes(h, words.first, width)
    parts, docs = [gram], [np.repeat(np.arange(words.docs), np.diff(first))]
    for n in range(1, width):
        own = np.flatnonzero(words.counts == n)
        parts.append(join_hashes([h[words.first[own] + k] for k in range(n)]))
        docs.append(own)
    gram, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    gram, doc = gram[new], doc[new]
    return gram, np.searchsorted(doc, np.arange(words.docs + 1))


def digests(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash per set, whatever the order of its shingles."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        with np.errstate(over="ignore"):
            a = np.add.reduceat(mix(gram), first[full])
            b = np.add.reduceat(mix(gram ^ np.uint64(0xA5A5A5A5F00DF00D)), first[full])
        out[full] = join_hashes([a, b, np.diff(first)[full].astype(np.uint64)])
    return out


SENT = "bucket int, class binary, size binary, n binary, gram binary, doc_id binary, no_id binary, doc_class binary, doc_n binary"
SENT_COLUMNS = [c.split()[0] for c in SENT.split(", ")][1:]


def send_shingles(docs: DataFrame, buckets: int, width: int, text: str, doc_id: str) -> DataFrame:
    """Shingles by bucket, a row per slice of the input and bucket; one bucket
    per slice also carries the slice's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SEND_BYTES):
            gram, first = shingle_sets(batch.column("text"), width)
            digest, n = digests(gram, first), np.diff(first)
            own = np.unique(digest, return_index=True)[1]
            own = np.sort(own[n[own] > 0])
            slot = np.full(len(n), -1, np.int64)
            slot[own] = np.arange(len(own))
            who = np.repeat(slot, n)
            gram, who = gram[who >= 0], who[who >= 0]
            bucket = ((gram >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((who, bucket))
            gram, who = gram[order], who[order]
            edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
            ids = batch.column("doc_id")
            home = int(digest.sum(dtype=np.uint64) % np.uint64(buckets))
            # Buckets with shingles of this slice only: their number is bounded by the
            # slice, while that of all buckets grows with the input.
            for b in np.union1d(np.flatnonzero(np.diff(edge)), [home]).tolist():
                lo, hi = edge[b], edge[b + 1]
                per = np.bincount(who[lo:hi], minlength=len(own))
                some = np.flatnonzero(per)
                cells = [digest[own[some]], n[own[some]].astype(np.int32), per[some].astype(np.int32),
                         gram[lo:hi].view(np.uint8).reshape(-1, 8)[:, :6]]
                cells += [ids.fill_null(0).to_numpy(zero_copy_only=False),
                          ids.is_null().to_numpy(zero_copy_only=False), digest, n.astype(np.int64)] \
                    if b == home else [np.empty(0, np.uint8)] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in cells)],
                    names=["bucket", *SENT_COLUMNS])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return arrow_map(rows, run, SENT)


def _joined(group: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)])


SHARED = "home int, class binary, size binary, n binary, gram binary, df binary, doc_id binary, no_id binary, doc_class binary, doc_n binary"
SHARED_COLUMNS = [c.split()[0] for c in SHARED.split(", ")][1:]


def _lists_of(homes: int):
    """A bucket's inverted lists: shingles of two classes or more go back to the
    homes of their classes; documents pass through."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        names, at = np.unique(_joined(group, "class", np.uint64), return_inverse=True)
        per = _joined(group, "n", np.int32)
        size = np.zeros(len(names), np.int32)
        size[at.reshape(-1)] = _joined(group, "size", np.int32)
        who = np.repeat(at.reshape(-1), per)
        raw = _joined(group, "gram", np.uint8).reshape(-1, 6)
        gram = np.zeros((len(raw), 8), np.uint8)
        gram[:, :6] = raw
        gram = gram.view(np.uint64).reshape(-1)
        order = np.lexsort((who, gram))
        gram, who = gram[order], who[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (who[1:] != who[:-1])
        gram, who = gram[new], who[new]
        _, run_of, df = np.unique(gram, return_inverse=True, return_counts=True)
        df = df[run_of.reshape(-1)].astype(np.int32) if len(gram) else np.empty(0, np.int32)
        # 48 bits of the hash and 16 of the bucket, which is its beginning.
        gram, who, df = gram[df > 1] | np.uint64((bucket & 0xFFFF) << 48), who[df > 1], df[df > 1]
        order = np.argsort(who, kind="stable")
        gram, who, df = gram[order], who[order], df[order]
        home = (names[who] % np.uint64(homes)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        gram, who, df = gram[order], who[order], df[order]
        edge = np.searchsorted(home[order], np.arange(homes + 1))
        rows = {c: [] for c in ["home", *SHARED_COLUMNS]}
        for k in np.flatnonzero(np.diff(edge)):
            lo, hi = edge[k], edge[k + 1]
            first = np.flatnonzero(np.diff(who[lo:hi], prepend=-1))
            own = who[lo:hi][first]
            cells = (names[own], size[own], np.diff(np.append(first, hi - lo)).astype(np.int32), gram[lo:hi], df[lo:hi])
            rows["home"].append(int(k))
            for c, x in zip(SHARED_COLUMNS, [*(x.tobytes() for x in cells), *[b""] * 4]):
                rows[c].append(x)
        # Documents stay apart from classes: a class may have any number of them.
        members = [c for c in range(group.num_rows) if len(group.column("doc_n")[c].as_buffer())]
        for c in members:
            rows["home"].append(-1 - bucket)
            for name in SHARED_COLUMNS[:5]:
                rows[name].append(b"")
            for name in SHARED_COLUMNS[5:]:
                rows[name].append(group.column(name)[c].as_py())
        return pa.table(rows, schema=pa.schema(
            [("home", pa.int32()), *((c, pa.binary()) for c in SHARED_COLUMNS)]))

    return run


FOUND = "class bigint, n bigint, doc_id bigint, is_doc boolean, prefix array<bigint>, grams binary"


def _classes_of(percent: int):
    """At home: documents as rows; classes with enough shared shingles, these in
    the global order and their prefix."""
    schema = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("is_doc", pa.bool_()),
                        ("prefix", pa.list_(pa.int64())), ("grams", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        if group.column("home")[0].as_py() < 0:
            ids, no = _joined(group, "doc_id", np.int64), _joined(group, "no_id", np.bool_)
            m = len(ids)
            return pa.table([pa.array(_joined(group, "doc_class", np.int64)), pa.array(_joined(group, "doc_n", np.int64)),
                             pa.array(ids, mask=no), pa.array(np.ones(m, bool)),
                             pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.binary())], schema=schema)
        names, at = np.unique(_joined(group, "class", np.int64), return_inverse=True)
        per = _joined(group, "n", np.int32)
        size = np.zeros(len(names), np.int64)
        size[at.reshape(-1)] = _joined(group, "size", np.int32)
        who = np.repeat(at.reshape(-1), per)
        gram, df = _joined(group, "gram", np.uint64), _joined(group, "df", np.int32)
        need = least_overlap(size, percent)
        some = np.bincount(who, minlength=len(names)) >= need
        gram, df, who = gram[some[who]], df[some[who]], who[some[who]]
        order = np.lexsort((gram, df, who))
        gram, who = gram[order], who[order]
        own = np.flatnonzero(some)
        first = np.searchsorted(who, np.append(own, len(names)))
        prefix, grams = [], []
        for k, c in enumerate(own):
            lo, hi = first[k], first[k + 1]
            lead = max(0, int(size[c] - need[c] + 1 - (size[c] - (hi - lo))))
            prefix.append(gram[lo:lo + lead].view(np.int64))
            grams.append(gram[lo:hi].tobytes())
        m = len(own)
        return pa.table([pa.array(names[own]), pa.array(size[own]), pa.nulls(m, pa.int64()), pa.array(np.zeros(m, bool)),
                         pa.array(prefix, pa.list_(pa.int64())), pa.array(grams, pa.binary())], schema=schema)

    return run


def merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The entries of sorted lists in order, and how many lists hold each."""
    if sum(map(len, lists)) <= HEAP_LIMIT:
        values = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64)
    else:
        values = np.sort(np.concatenate(lists), kind="stable")
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.diff(np.append(first, len(values)))


class Family:
    """Inverted lists over the classes of one family (or one pair of shards)."""

    def __init__(self, size: np.ndarray, grams: list[np.ndarray], percent: int):
        self.size, self.percent = size, percent
        n = np.array([len(g) for g in grams])
        _, token = np.unique(np.concatenate(grams), return_inverse=True)
        token, who = token.reshape(-1).astype(np.int64), np.repeat(np.arange(len(grams)), n)
        self.tokens = np.split(token, np.cumsum(n)[:-1])
        order = np.lexsort((who, token))
        self.entry = who[order]
        self.begin = np.searchsorted(token[order], np.arange(token.max() + 2))
        # All lists as one sorted array, for binary probes into any of them.
        self.key = token[order] * len(grams) + self.entry
        self.root = np.arange(len(grams))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.root[x]
        while not np.array_equal(up := self.root[r], r):
            r = up
        return r

    def partners(self, q: int, usable: np.ndarray | None = None) -> list[int]:
        """Classes before ``q`` that link with it and were not connected to it
        yet; connects them."""
        need = int(least_overlap(self.size[q:q + 1], self.percent)[0])
        t = self.tokens[q]
        length = self.begin[t + 1] - self.begin[t]
        t, length = t[length > 1], length[length > 1]
        if len(t) < need:
            return []
        t = t[np.argsort(length, kind="stable")]
        longest = int(length.max())
        long = min(need - 1, int(need / (MU * np.log2(longest) + 1)))
        short, long_t = t[:len(t) - long], t[len(t) - long:]
        who, count = merged([self.entry[self.begin[x]:self.begin[x + 1]] for x in short.tolist()])
        ok = (who < q) & (count >= need - long)
        if usable is not None:
            ok &= usable[who]
        who, count = who[ok], count[ok]
        n, m = int(self.size[q]), self.size[who]
        total = -(-self.percent * (n + m) // (100 + self.percent))
        ok = (count + long >= total) & (np.minimum(n, m) >= total)
        who, count, total = who[ok], count[ok], total[ok]
        order = np.argsort(-count, kind="stable")
        who, count, total = who[order], count[order], total[order]
        found, batch = [], 1
        while len(who):
            roots = self.roots(who)
            apart = roots != self.find(q)
            who, count, total, roots = who[apart], count[apart], total[apart], roots[apart]
            if not len(who):
                break
            # The most promising candidates of every component first.
            by = np.argsort(roots, kind="stable")
            lead = np.flatnonzero(np.diff(roots[by], prepend=-1))
            nth = np.arange(len(by)) - np.repeat(lead, np.diff(np.append(lead, len(by))))
            now = np.zeros(len(who), bool)
            now[by[nth < batch]] = True
            probe = (long_t[:, None] * len(self.size) + who[now]).ravel()
            at = np.minimum(np.searchsorted(self.key, probe), len(self.key) - 1)
            hits = (self.key[at] == probe).reshape(len(long_t), -1).sum(0)
            for c in who[now][count[now] + hits >= total[now]].tolist():
                a, b = self.find(q), self.find(c)
                if a != b:
                    self.root[max(a, b)] = min(a, b)
                    found.append(c)
            who, count, total = who[~now], count[~now], total[~now]
            batch *= 4
        return found


def _search(percent: int):
    """Searches the families of a bucket. A whole family gives ``(class, root)``
    of all its classes that link (``done``); a pair of shards gives links that
    connect all that link across it, or within it if it is one shard twice."""

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        family = group.column("family").to_numpy()
        size, name = group.column("n").to_numpy(), group.column("class").to_numpy()
        grams, whole = group.column("grams"), bool(group.column("whole")[0].as_py())
        order = np.lexsort((name, size, family))
        a, b = [], []
        edge = np.append(np.flatnonzero(np.diff(family[order], prepend=family[order[0]] - 1)), len(order))
        for lo, hi in zip(edge, edge[1:]):
            own = order[lo:hi]
            if hi - lo < 2:
                continue
            f = Family(size[own], [np.frombuffer(grams[int(i)].as_buffer(), np.uint64) for i in own], percent)
            across = side[own].any()
            for q in range(1, len(own)):
                usable = side[own] != side[own[q]] if across else None
                found = f.partners(q, usable)
                if not whole:
                    a += [name[own[q]]] * len(found)
                    b += [name[own[c]] for c in found]
            if whole:
                root = f.roots(np.arange(len(own)))
                away = root != np.arange(len(own))
                a += name[own[away]].tolist()
                b += name[own[root[away]]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                         "done": pa.array([whole] * len(a), pa.bool_())})

    return run


def _roots(classes: DataFrame, percent: int, family_limit: int) -> DataFrame:
    """``(class, root)`` of the classes that link; classes with equal roots are
    connected. A class without a row is its own root."""
    spark = classes.sparkSession
    postings = staged(classes.select("class", F.explode("prefix").alias("gram")), "prefix-postings")
    hubs = staged(postings.groupBy("gram").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("k"))
                  .where("k > 1").select("gram", "hub"), "prefix-hubs")
    edges = postings.join(hubs, "gram").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    family = staged(components(edges).select(F.col("node").alias("class"), F.col("root").alias("family")), "families")
    own = staged(classes.join(family, "class").select("family", "class", "n", "grams"), "family-classes")
    sizes = own.groupBy("family").agg(F.count(F.lit(1)).alias("k"))
    large = staged(sizes.where(F.col("k") > family_limit).select(
        "family", F.ceil(F.col("k") / (family_limit // 2)).cast("int").alias("shards")), "large-families")
    total = own.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    tasks = pieces_for(total, FAMILY_BYTES, least=spark.sparkContext.defaultParallelism)
    small = own.join(large, "family", "left_anti").select(
        F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("task"), F.lit(0).alias("side"), F.lit(True).alias("whole"),
        "family", "class", "n", "grams")
    shard = F.pmod(F.xxhash64("class"), F.col("shards")).cast("int")
    cut = own.join(large, "family").withColumn("s", shard).withColumn(
        "o", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    cut = cut.select(
        F.xxhash64("family", F.least("s", "o"), F.greatest("s", "o")).alias("task"),
        F.when(F.col("s") == F.col("o"), 0).when(F.col("s") < F.col("o"), 1).otherwise(2).alias("side"),
        F.lit(False).alias("whole"), "family", "class", "n", "grams")
    schema = "a bigint, b bigint, done boolean"
    found = staged(arrow_groups(small.unionByName(cut), ["task"], _search(percent), schema), "shingle-links")
    done = found.where("done").select(F.col("a").alias("class"), F.col("b").alias("root"))
    if not large.limit(1).count():
        return done
    rest = components(found.where("not done").select("a", "b"))
    return done.unionByName(rest.select(F.col("node").alias("class"), "root"))


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
                       percent: int = PERCENT, family_limit: int = FAMILY_LIMIT) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that
    links reach (its own without links)."""
    total = text_bytes(docs, text)
    buckets = pieces_for(total, BUCKET_BYTES, least=LEAST_BUCKETS)
    sent = send_shingles(docs, buckets, width, text, doc_id)
    lists = arrow_groups(sent, ["bucket"], _lists_of(buckets), SHARED)
    found = staged(arrow_groups(lists, ["home"], _classes_of(percent), FOUND), "shingle-classes")
    members = found.where("is_doc").select("class", F.col("n").alias("n_shingles"), "doc_id")
    classes = found.where("not is_doc and size(prefix) > 0").select("class", "n", "prefix", "grams")
    roots = staged(_roots(classes, percent, family_limit), "class-roots")
    first = members.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    whole = staged(first.join(roots, "class", "left").select(
        "class", F.coalesce("root", "class").alias("root"), "first"), "class-firsts")
    least = staged(whole.groupBy("root").agg(F.min("first").alias("component_id")), "component-firsts")
    ids = staged(whole.join(least, "root").select("class", "component_id"), "class-components")
    return members.join(ids, "class", "left").select(
        F.col("doc_id").alias(doc_id), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its
    columns; documents without an id stay. Components are of texts, so that several
    texts under one id are judged each by its own links: the id stays with those of
    its texts that are first in their component, with one where they link with each
    other. Of equal rows in this sense the one whose columns have the least hash stays."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.withColumn("_text_key", F.xxhash64(F.col(f"`{text}`").cast("string")))
    found = jaccard_components(own.select("_text_key", F.col(f"`{text}`").alias("text")), text="text",
                               doc_id="_text_key", **options)
    found = staged(found.distinct(), "text-components")
    ids = own.select(F.col(f"`{doc_id}`").alias("_id"), "_text_key").where("_id IS NOT NULL").distinct()
    placed = ids.join(found, "_text_key")
    first = placed.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("_id", "_text_key")).alias("r")) \
        .select("r.*")
    # Texts without shingles link with nothing: each id keeps its own.
    kept = first.unionByName(placed.where("n_shingles = 0").select("_id", "_text_key"))
    kept = staged(kept.withColumnRenamed("_text_key", "_kept_key"), "kept-texts")
    one = own.join(kept, (F.col(f"`{doc_id}`") == F.col("_id")) & (F.col("_text_key") == F.col("_kept_key")), "left_semi")
    place = Window.partitionBy(F.col(f"`{doc_id}`"), "_text_key").orderBy(F.xxhash64(*names))
    one = one.withColumn("_keep_place", F.row_number().over(place)).where("_keep_place = 1").select(*names)
    return one.unionByName(docs.where(F.col(f"`{doc_id}`").isNull()))

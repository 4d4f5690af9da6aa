"""Operator 8, URL filters: a sorted digest array.

Entries are ``host/path-prefix`` strings with an action. Their 64-bit xxhash
digests are kept sorted, beside the full strings, in one flat file that every
worker maps into memory. A URL is probed with every host suffix and path
prefix whose lengths occur together in an entry; all probes of a batch are
one vectorised binary search, and a digest that is found counts only if the
stored string is equal (digests can collide). Only host suffixes and path
prefixes of lengths that entries have are made, so a long URL costs no more. Rules (``allow`` and ``block``)
go before plain ``listed`` entries; then the longest that fits wins, and at
equal length ``allow`` beats ``block``.

An index of more than ``max_bytes`` is cut into that many digest ranges, each
sent and probed on its own; the best entry so far travels with the row.

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no entry; repeated URLs are judged alike; an empty table gives no
rows, an empty list lets everything through; other columns pass through inside
``row``.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import arrow_map, pieces_for, staged

#: Actions, strongest first.
ACTIONS = ("allow", "block", "listed")
MAX_BYTES = 64 << 20
SEED = 42

#: Fixed values given by the contract of the query: action, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Names of hosts that the query's own list rejects, under each public suffix.
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED = [("listed", f"{name}.example.{tld}", "") for name in LISTED_NAMES
          for tld in ("com", "net", "org")]
ENTRY = "action string, host string, path string"


def host_of(url) -> F.Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url) -> F.Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def entries_frame(spark, entries: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(entries), ENTRY)


def build_index(entries: list[tuple[str, str, str]]) -> bytes:
    """The flat file: count, digests, end offsets, host and path lengths, actions, strings."""
    rows = sorted({(xxhash.xxh64_intdigest((h + p).encode(), SEED), h + p, len(h), len(p), ACTIONS.index(a))
                   for a, h, p in entries})
    blobs = [r[1].encode() for r in rows]
    return b"".join([
        np.array([len(rows)], "<u8").tobytes(),
        np.array([r[0] for r in rows], "<u8").tobytes(),
        np.cumsum([len(b) for b in blobs], dtype="<u8").tobytes() if rows else b"",
        np.array([r[2] for r in rows], "<u4").tobytes(),
        np.array([r[3] for r in rows], "<u4").tobytes(),
        np.array([r[4] for r in rows], "u1").tobytes(), *blobs])


def rank(text: str, action: int) -> tuple[bool, int, int, str]:
    """Greater is better: rules, then length, then the stronger action."""
    return action < 2, len(text), -action, text


class DigestArray:
    """The memory-mapped index. The file has no name and goes with the worker."""

    def __init__(self, raw: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(raw)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = lambda kind, n, at: np.frombuffer(self.map, kind, n, at)
        n = int(view("<u8", 1, 0)[0])
        self.digest, self.end = view("<u8", n, 8), view("<u8", n, 8 + 8 * n)
        self.action, self.base = view("u1", n, 8 + 24 * n), 8 + 25 * n
        #: Path lengths by host length, both ascending.
        self.lengths: dict[int, list[int]] = {}
        for h, p in sorted(set(zip(view("<u4", n, 8 + 16 * n).tolist(), view("<u4", n, 8 + 20 * n).tolist()))):
            self.lengths.setdefault(h, []).append(p)

    def text(self, i: int) -> bytes:
        begin = int(self.end[i - 1]) if i else 0
        return self.map[self.base + begin:self.base + int(self.end[i])]

    def best(self, hosts: list[str], paths: list[str]) -> list[tuple[int, int, str] | None]:
        """Per URL the best entry, as ``rank`` gives it, or None."""
        owner, probe = [], []
        for row, (host, path) in enumerate(zip(hosts, paths)):
            if not host:
                continue
            for size, path_lengths in self.lengths.items():
                at = len(host) - size
                if at < 0:
                    break
                if at and host[at - 1] != ".":
                    continue
                for n in path_lengths:
                    if n > len(path):
                        break
                    owner.append(row)
                    probe.append((host[at:] + path[:n]).encode())
        out: list[tuple | None] = [None] * len(hosts)
        if not probe or not len(self.digest):
            return out
        digests = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in probe), np.uint64, len(probe))
        left = np.searchsorted(self.digest, digests, "left")
        right = np.searchsorted(self.digest, digests, "right")
        for k in np.flatnonzero(right > left).tolist():
            for i in range(left[k], right[k]):
                if self.text(i) == probe[k]:
                    text = probe[k].decode()
                    found = rank(text, int(self.action[i]))
                    row = owner[k]
                    if out[row] is None or found > out[row]:
                        out[row] = found
        return out


def judge(pages: DataFrame, entries: DataFrame, url: str = "url",
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """A row per page: ``row`` (its columns), ``host``, ``path``, ``entry`` and
    ``action`` of the best entry (null if none fits)."""
    sizes = entries.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 25)).first()[0] or 0
    shards = pieces_for(sizes, max_bytes)
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        F.lit(None).cast("string").alias("entry"), F.lit(None).cast("string").alias("action"))
    key = F.pmod(F.xxhash64(F.concat("host", "path")), F.lit(shards))
    for shard in range(shards):
        own = entries.select("action", "host", "path").where(key == shard).collect()
        sent = pages.sparkSession.sparkContext.broadcast(build_index([tuple(r) for r in own]))
        rows = arrow_map(rows, _probe(sent), rows.schema)
        if shard + 1 < shards:
            rows = staged(rows, "url-shard")
    return rows


def _probe(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(sent.value)
        for batch in batches:
            hosts, paths, entry, action = (batch.column(c).to_pylist()
                                           for c in ("host", "path", "entry", "action"))
            for i, found in enumerate(index.best(hosts, paths)):
                old = entry[i] is not None and rank(entry[i], ACTIONS.index(action[i]))
                if found and (not old or found > old):
                    entry[i], action[i] = found[3], ACTIONS[-found[2]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(entry, pa.string()), pa.array(action, pa.string())],
                names=batch.schema.names)
    return run


def verdicts(judged: DataFrame) -> DataFrame:
    """page_id, host, path, the rule that decided (null if none), the verdict
    and the entry of the list, if that decided."""
    by_rule = F.col("action").isin("allow", "block")
    return judged.select(
        F.col("row.page_id").alias("page_id"), "host", "path",
        F.when(by_rule, F.col("entry")).alias("rule"),
        F.when(by_rule, F.col("action")).when(F.col("action") == "listed", F.lit("block"))
         .otherwise(F.lit("allow")).alias("verdict"),
        F.when(F.col("action") == "listed", F.col("entry")).alias("listed"))


def _values(rows) -> str:
    return ", ".join("({}, '{}', '{}')".format(ACTIONS.index(a), h, p) for a, h, p in rows)


ORACLE = rf"""
WITH e(k, h, p) AS (VALUES {_values(RULES + LISTED)}),
u AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
m AS (
  SELECT n, k, h || p AS entry,
    row_number() OVER (PARTITION BY n ORDER BY k = 2, length(h || p) DESC, k) AS r
  FROM u JOIN e ON (u.host = h OR u.host LIKE '%.' || h) AND starts_with(path, p) WHERE u.host <> '')
SELECT page_id, host, path, CASE WHEN k < 2 THEN entry END AS rule,
  CASE WHEN k = 0 THEN 'allow' WHEN k >= 1 THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN k = 2 THEN entry END AS listed
FROM u LEFT JOIN (SELECT * FROM m WHERE r = 1) USING (n)
"""

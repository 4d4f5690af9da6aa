"""Operator 4, packing: concatenate and cut.

All documents form one stream of tokens, which is cut into windows of
``length`` tokens. Pass one tokenizes every document, once, and writes its ids
with the running token total inside its task (the boundary records of one
partition). The totals of all partitions, one number each, are summed up to
give every partition its place in the stream; nothing else reaches the driver.
Pass two adds the two, cuts each document at the window boundaries and writes
a record per piece. There is no shuffle: both passes run where the data lies.

All windows but the last are full, so padding is less than one window in all.

Defined results: a null text is an empty one and gives the end id alone; an
empty table gives no rows; ties and repeated rows are packed as often as they
come; a document longer than a window is cut into as many pieces as needed;
other columns of the input are not used.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import arrow_map, staged
from barsmith.llm.tokens import WORD_BPE, word_bpe_cache
from barsmith.llm.words import text_slices, words_of

TOKENS = "part int, doc_id bigint, start_in_part bigint, n_tokens bigint, ids binary"
PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, ids binary")
#: Text bytes tokenized at once: every worker of an executor holds some twenty
#: times as much beside its vocabulary and known words.
SEND_BYTES = 512 << 10
_CACHE: dict[str, object] = {}


def tokenize(docs: DataFrame, vocabulary: str = WORD_BPE, end_id: int = 2) -> DataFrame:
    """Pass one: a row per document with its ids (little-endian 16-bit) and the
    number of tokens before it in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _CACHE:
            _CACHE[vocabulary] = word_bpe_cache(vocabulary)
        cache = _CACHE[vocabulary]
        part, done = TaskContext.get().partitionId(), 0
        for batch in text_slices(batches, "text", SEND_BYTES):
            words = words_of(batch.column("text"))
            ids, size = cache.encode_words(words)
            before = np.concatenate([[0], np.cumsum(size)])[words.first]
            # One end id after each document.
            raw = np.insert(ids, before[1:], end_id).astype("<u2")
            edge = before + np.arange(len(before))
            n = np.diff(edge)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(n), part, np.int32)), batch.column("doc_id"),
                pa.array(done + edge[:-1]), pa.array(n),
                pa.Array.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer((2 * edge).astype(np.int32)), pa.py_buffer(raw)]),
            ], names=["part", "doc_id", "start_in_part", "n_tokens", "ids"])
            done += int(edge[-1])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, TOKENS)


def partition_offsets(tokens: DataFrame) -> dict[int, int]:
    """Where each partition begins in the stream: the prefix sums of the
    partitions' totals. One number per partition of pass one."""
    totals = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.sum("n_tokens")).collect())
    ends = itertools.accumulate(n for _, n in totals)
    return {part: end - n for (part, n), end in zip(totals, ends)}


def cut(tokens: DataFrame, offsets: dict[int, int], length: int = 4096, crc32: bool = False) -> DataFrame:
    """Pass two: the pieces of every document, with their ids or, if ``crc32``,
    with ``ids_crc32``, the CRC-32 of the ids as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, local, n = (batch.column(c).to_numpy(zero_copy_only=False)
                              for c in ("part", "start_in_part", "n_tokens"))
            begin = np.array([offsets[p] for p in part.tolist()], np.int64) + local
            first, last = begin // length, (begin + n - 1) // length
            count = last - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            sequence = first[doc] + nth
            lo = np.maximum(sequence * length, begin[doc])
            hi = np.minimum((sequence + 1) * length, (begin + n)[doc])
            start, size = lo - begin[doc], hi - lo
            ids = batch.column("ids")
            values = [ids[i].as_buffer() for i in range(len(n))]
            raw = [values[d].slice(2 * s, 2 * k)
                   for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist())]
            last = pa.array([zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in raw],
                            pa.int64()) if crc32 else pa.array([x.to_pybytes() for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(size),
                pa.array(n[doc]), pa.array(sequence), pa.array(lo - sequence * length),
                last,
            ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset",
                      "ids_crc32" if crc32 else "ids"])

    return arrow_map(tokens, run, PIECES.replace("ids binary", "ids_crc32 bigint") if crc32 else PIECES)


def pack(docs: DataFrame, length: int = 4096, vocabulary: str = WORD_BPE,
         end_id: int = 2, crc32: bool = False) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``
    of all documents; ``ids`` holds little-endian 16-bit numbers. With
    ``crc32`` there is ``ids_crc32`` in their place."""
    tokens = staged(tokenize(docs, vocabulary, end_id), "packing-tokens")
    return cut(tokens, partition_offsets(tokens), length, crc32)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: ids joined in order, with the boundary records
    ``(doc_id, start, offset, length)``. A sequence has a bounded length."""
    record = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(record)).alias("r"))
    joined = F.aggregate("r", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.transform("r", lambda x: F.struct(
        x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["offset"].alias("offset"),
        x["length"].alias("length"))).alias("boundaries"))

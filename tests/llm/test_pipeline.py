import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as cp
from barsmith.llm import linespread, resample
from tests.llm import test_decontaminate, test_linespread, test_packing, test_toccurrence

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    now = docs
    for name, stage in cp.STAGES:
        rows = {r.doc_id: r for r in now.collect()}
        got = stage(spark, now, SF)
        if name != "packing":
            assert got.columns == docs.columns
            after = {r.doc_id: r for r in got.collect()}
        if name == "quality":
            assert set(after) == brute_quality(spark, rows)
            assert all(after[i] == rows[i] for i in after)
        elif name == "line_dedup":
            want = {x[0]: x[1] for x in test_linespread.brute(
                [(r.doc_id, r.text, r.source) for r in rows.values()], linespread.MIN_SITES)}
            assert {i: r.text for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_duplicates":
            want = test_toccurrence.brute([(r.doc_id, r.text) for r in rows.values()])
            assert set(after) == {d for d, _, c in want if d == c}
        elif name == "decontamination":
            want = test_decontaminate.brute([(r.doc_id, r.text) for r in rows.values()], bench)
            assert set(after) == {x[0] for x in want if not x[5]}
        else:
            ids = dict(zip(rows, test_packing.expected([r.text for r in rows.values()])))
            offset = {}
            for p in sorted(got.collect(), key=lambda p: (p.sequence_id, p.offset)):
                part = ids[p.doc_id][p.start:p.start + p.length]
                assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
                assert p.offset == offset.get(p.sequence_id, 0)
                offset[p.sequence_id] = p.offset + p.length
            assert sum(offset.values()) == sum(map(len, ids.values()))
        now = cp.staged(got, "test-stage")


def brute_quality(spark, rows):
    """The first stage with dictionaries: token n-grams, log ratios, noise, top k."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    bits = 16
    weight, _, _ = resample.fit(spark.read.parquet(f"{SF}/documents.parquet"),
                                spark.read.parquet(f"{SF}/labels.parquet"))
    raw, good, each = np.zeros(1 << bits), np.zeros(1 << bits), {}
    for i, r in rows.items():
        tokens = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0D]+", r.text)
        bucket, doc, n = resample.buckets_of(pa.array([r.text]), bits)
        assert n[0] == len(tokens) and len(bucket) == max(0, 2 * len(tokens) - 1)
        each[i] = bucket
        raw += np.bincount(bucket, minlength=1 << bits)
        good += np.bincount(bucket, minlength=1 << bits) * (labels.get(i) == 1)
    a = min(1.0, raw.sum() / (4 << bits))
    p = (raw + a) / (raw.sum() + a * (1 << bits))
    q = (good + a * (1 << bits) * p) / (good.sum() + a * (1 << bits))
    assert np.allclose(weight, np.log(q / p))
    noise = {r.doc_id: r["sum"] - r["log_weight"] for r in resample.score(
        spark.read.parquet(f"{SF}/documents.parquet"), weight).select("row.doc_id", "sum", "log_weight").collect()}
    logw = {i: weight[b].sum() for i, b in each.items()}
    cut = resample.best_cut([logw[i] for i in rows if labels.get(i) == 1], [logw[i] for i in rows if labels.get(i) == 0])
    k = sum(w >= cut - 3 for w in logw.values())
    return set(sorted(rows, key=lambda i: -(logw[i] + noise[i]))[:k])


def test_clean_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r.doc_id for r in cp.quality(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert np.mean([i in kept for i in good]) > 0.99
    assert np.mean([i in kept for i in bad]) < 0.1


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (None, "b c", "en", "a", 3, "x"),
            (3, "same text here", "en", "b", 14, "x"), (3, "same text here", "en", "b", 14, "x"),
            (4, "w " * 30000, None, None, 60000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    now = docs
    for name, stage in cp.STAGES[:-1]:
        now = cp.staged(stage(spark, now, SF), "test-odd")
        assert now.columns == docs.columns
    assert {r.doc_id for r in now.collect()} >= {1, 2, 3, None}
    assert now.where("doc_id = 3").count() == 1
    empty = docs.limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0, 2.0, -1e9], [5.0] * 7, [1e-300, 2e-300, 1.0, math.pi]])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in range(1, len(values) + 1):
        assert resample.kth_largest(df, "x", k, width=3) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(df, "x", 0) == math.inf

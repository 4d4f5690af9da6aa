import math

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import resample


def make(spark, n=300):
    good = [(i, f"the quick word {i % 17} runs home again number {i % 5}", "s") for i in range(n)]
    bad = [(n + i, f"buy!!! %%% now$$$ {i % 7} ### " * 5, "s") for i in range(n // 3)]
    return spark.createDataFrame(good + bad, "doc_id long, text string, kept string").repartition(3), n


def labelled(spark, n):
    rows = [(i, 1) for i in range(0, n, 3)] + [(n + i, 0) for i in range(0, n // 3, 3)] + [(None, 1), (5, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_junk_goes_and_good_stays(spark):
    docs, n = make(spark)
    got = resample.resample(docs, labelled(spark, n)).collect()
    assert len(got) == n + n // 3
    assert all(r.kept == (r.row.doc_id < n) for r in got)
    kept = resample.keep(docs, labelled(spark, n))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(n))


def test_top_k_is_exact_and_follows_the_weights(spark):
    docs, n = make(spark)
    rows = resample.resample(docs, labelled(spark, n), k=37).collect()
    top = sorted(rows, key=lambda r: -r["sum"])[:37]
    assert {r.row.doc_id for r in rows if r.kept} == {r.row.doc_id for r in top}
    noise = np.array([r["sum"] - r.log_weight for r in rows])
    assert abs(noise.mean() - 0.5772) < 0.25 and abs(noise.var() - math.pi ** 2 / 6) < 0.5
    other = resample.resample(docs, labelled(spark, n), k=37, seed=5).collect()
    assert {r.row.doc_id for r in other if r.kept} != {r.row.doc_id for r in rows if r.kept}


def test_without_labels_everything_stays(spark):
    docs, n = make(spark)
    none = labelled(spark, n).limit(0)
    assert all(r.kept for r in resample.resample(docs, none).collect())
    assert resample.resample(docs.limit(0), labelled(spark, n)).count() == 0
    odd = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "a " * 100_000, "x"), (2, "a " * 100_000, "x")],
                                "doc_id long, text string, kept string")
    got = resample.resample(odd, none).collect()
    assert [r.log_weight for r in got if r.row.doc_id != 2] == [0.0, 0.0] and len(got) == 4


def test_buckets_of_a_column():
    bucket, doc, n = resample.buckets_of(pa.array(["ab ab ab", None, "x!! x", "ab"]), 16)
    assert n.tolist() == [3, 0, 3, 1]
    assert np.bincount(doc, minlength=4).tolist() == [5, 0, 5, 1]
    assert bucket[1] == bucket[2] != bucket[0]  # repeats are ditto marks


@pytest.mark.parametrize("good,bad,lo,hi", [([3, 4, 5], [0, 1], 1, 3), ([], [1], -math.inf, -math.inf),
                                            ([1, 2, 9], [1, 0], 0, 9)])
def test_best_cut(good, bad, lo, hi):
    assert lo <= resample.best_cut(good, bad) <= hi

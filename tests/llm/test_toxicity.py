import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barsmith.llm import toxicity as tx
from barsmith.llm.queries import remainder
from barsmith.llm.words import ALNUM, words_of

SF = "/root/testdata/sf0.1"


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(1)
    net = tx.ConvNet(dim=3, per_width=2, widths=(1, 2), seed=3)
    net.table = net.table.astype(np.float64) * 10
    net.filters = {w: f.astype(np.float64) for w, f in net.filters.items()}
    rows = rng.integers(0, 50, (4, 12))
    first, y, w = np.array([0, 5, 6, 12]), np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss(m):
        pool, _ = m.pooled(m.vectors(rows), first)
        z = np.maximum(pool + m.bias, 0) @ m.out + m.out_bias
        return (w * (np.logaddexp(0, z) - y * z)).mean()

    import copy
    base = copy.deepcopy(net)
    state = {}
    net.step(rows, first, y, w, state, 0.0)
    for name, get in (("out", lambda m: m.out), (2, lambda m: m.filters[2]), (1, lambda m: m.filters[1]),
                      ("table", lambda m: m.table)):
        size = np.sqrt(state[name])
        k = np.unravel_index(np.argmax(size), size.shape)
        up, down = copy.deepcopy(base), copy.deepcopy(base)
        get(up)[k] += 1e-3
        get(down)[k] -= 1e-3
        assert abs(abs(loss(up) - loss(down)) / 2e-3 - size[k]) < 0.02 * size[k] + 2e-2, name


def test_held_out_accuracy(spark):
    """Fitted without a fifth of the labelled rows, tried on that fifth."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = remainder(F.col("doc_id"), 5) == 0
    model = tx.fit(docs, labels, usable=~held)
    got = tx.score(docs.where(held), *model).select("row.doc_id", "score")
    rows = got.join(labels, "doc_id").select("score", "toxic").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert zlib.crc32(b"0") % 5 == (zlib.crc32(str(0).encode()) % 5)
    assert (s[y == 1] >= 0.5).mean() > 0.85
    assert (s[y == 0] >= 0.5).mean() < 0.03


@pytest.fixture(scope="module")
def model():
    rest = [" ".join(f"w{(i * k) % 23}" for k in range(1, 3 + i % 9)) for i in range(60)]
    texts = [f"plain words {t}" for t in rest] + [f"plain words badword{i % 7} {t}" for i, t in enumerate(rest)]
    words = [tx.rows_of(words_of(pa.array([t]), ALNUM)) for t in texts]
    return tx.train(words, np.array([0.0] * 60 + [1.0] * 60, np.float32), epochs=20), {"en": 0.4}


def test_odd_rows(spark, model):
    long = "plain words " * 200_000
    rows = [(1, None, "en"), (2, "", None), (3, long, "en"), (4, long + " badword3 ", "xx"), (5, "!!! ...", "en"),
            (5, "!!! ...", "en"), (None, "badword9 x", "en")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, "
                                 "score string, row int")
    got = tx.score(docs, *model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.row.doc_id: r for r in got}
    assert by[1].score == by[2].score == by[5].score < 0.5
    assert by[3].score < 0.5 < by[4].score and by[None].score > 0.5
    assert by[1].threshold == 0.4 and by[2].threshold == 0.5
    assert tx.score(docs.limit(0), *model).count() == 0


def test_one_class_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "c", "de")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for own in (labels, labels.limit(0)):
        net, cuts = tx.fit(docs, own)
        assert all(0 <= r.score <= 1 for r in tx.score(docs, net, cuts).collect())


def test_best_thresholds():
    s, y = np.array([0.1] * 30 + [0.35] * 30), np.array([0] * 30 + [1] * 30)
    cuts = tx.best_thresholds(s, y, ["en"] * 60)
    assert 0.1 < cuts["en"] <= 0.35
    assert tx.best_thresholds(s[:5], y[:5], ["de"] * 5) == {"de": 0.5}


def test_the_sample_is_of_short_texts_one_per_id(spark):
    """Long texts do not use up the sample, nor do repeated rows of one id."""
    long = "word " * 300
    rows = [(i, long if i % 3 else f"short text {i}", "en") for i in range(60)] + [(0, "short text 0", "en")] * 50
    rows += [(3, "another text of the id", "en"), (None, "no id", "en"), (999, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(999, 1)], "doc_id long, toxic int")
    got = tx.training_rows(docs, labels, F.lit(True), 8, 100)
    assert sum(y for _, y, _ in got) == 8 and len(got) == 16
    assert all(w.shape[1] <= 5 for w, _, _ in got)
    everything = tx.training_rows(docs, labels, F.lit(True), 1000, 100)
    assert len(everything) == 21


def test_thresholds_of_all_rows_equal_those_of_arrays(spark):
    rng = np.random.default_rng(4)
    rows = []
    for lang, n, shift in (("en", 400, 2.0), (None, 150, 1.0), ("de", 60, 3.0), ("xx", 30, 1.0), ("fr", 80, 0.0)):
        y = (rng.random(n) < (0.03 if lang == "xx" else 0.4)).astype(int)
        s = 1 / (1 + np.exp(-np.round(rng.normal(-1, 2, n) + shift * y, 1 if lang != "de" else 3)))
        rows += list(zip([lang] * n, s.tolist(), y.tolist()))
    df = spark.createDataFrame(rows, "lang string, score double, y int").repartition(5)
    got = tx.thresholds(df)
    want = tx.best_thresholds(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), [r[0] for r in rows])
    assert got.keys() == want.keys() and got["xx"] == 0.5
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want), (got, want)
    assert tx.thresholds(df.limit(0)) == {}


def test_thresholds_come_from_all_labelled_rows(spark):
    """With a sample too small for any threshold, the rows outside it set one."""
    rows = [(i, f"plain words number{i % 13} {'badword' if i % 2 else ''} w{i}", "en") for i in range(160)]
    docs = spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    seen = []
    real = tx.thresholds
    try:
        tx.thresholds = lambda scored: seen.append(scored.count()) or real(scored)
        tx.fit(docs, labels, sample_rows=10)
    finally:
        tx.thresholds = real
    assert seen == [160 - 16]

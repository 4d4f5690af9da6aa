"""Operator 3, toxicity: a convolutional text classifier in numpy.

A word's vector is the sum of four rows of a hashed embedding table: the row of
the word and those of its first 4, 5 and 6 bytes, so that inflected forms share
rows with their stem, and a word seldom shares all rows with another.
Filters of several widths run over all word positions of the whole text, each
filter's largest response goes through a rectifier, and a linear layer gives
the score. Training is by hand-written gradients and Adagrad on the driver,
over a bounded sample of labelled rows: up to ``sample_rows`` per class with
the smallest hashes among texts of at most ``sample_words`` words. Every
document is then scored, whole, where it lies.

``thresholds`` gives each language the threshold with the best F1 on all labelled
rows that took no part in training (0.5 for a language with few rows); the
language is never an input of the score.

Defined results: null and empty texts have no windows and get the score of no
response at all; repeated rows score alike; an empty table gives no rows; with
one class only in the sample, the score is that class's share; other columns
pass through inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barsmith.llm.staging import arrow_map, staged
from barsmith.llm.words import ALNUM, LOWER, Words, mix, prefix_hashes, text_slices, words_of

BITS = 17
PREFIXES = (4, 5, 6)


def rows_of(words: Words) -> np.ndarray:
    """The table rows of every word, one line per kind of hash."""
    h = prefix_hashes(words.data, words.start, words.end, [None, *PREFIXES], LOWER)
    kind = mix(np.arange(1, len(h) + 1, dtype=np.uint64))[:, None]
    return (mix(h ^ kind) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class ConvNet:
    """The network. ``filters[w]`` is (w, dim, n): one matrix per position."""

    dim: int = 8
    per_width: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    seed: int = 0
    table: np.ndarray = field(init=False)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.table = rng.normal(0, 0.05, (1 << BITS, self.dim)).astype(np.float32)
        self.filters = {w: rng.normal(0, 0.5, (w, self.dim, self.per_width)).astype(np.float32)
                        for w in self.widths}
        n = self.per_width * len(self.widths)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, n).astype(np.float32)
        self.out_bias = np.float32(0)

    def responses(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Every filter's response at every word; words beyond a document's end
        count as zero vectors."""
        flat = np.concatenate([f.transpose(1, 0, 2).reshape(self.dim, -1)
                               for f in self.filters.values()], 1)
        y = x @ flat
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(x))
        out, at = np.empty((len(x), len(self.bias)), np.float32), 0
        for i, w in enumerate(self.widths):
            part = y[:, at:at + self.per_width].copy()
            for j in range(1, w):
                col = y[j:, at + j * self.per_width:at + (j + 1) * self.per_width]
                part[:len(col)] += col * (left[:len(col)] > j)[:, None]
            out[:, i * self.per_width:(i + 1) * self.per_width] = part
            at += w * self.per_width
        return out

    def pooled(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response per document and filter (0 without words)."""
        r = self.responses(x, first)
        full = np.flatnonzero(np.diff(first))
        out = np.zeros((len(first) - 1, r.shape[1]), np.float32)
        if len(full):
            out[full] = np.maximum.reduceat(r, first[full], axis=0)
        return out, r

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.table[r] for r in rows)

    def predict(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        pool, _ = self.pooled(self.vectors(rows), first)
        z = np.maximum(pool + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def step(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray,
             state: dict, rate: float) -> None:
        """One Adagrad step on a batch of documents."""
        x = self.vectors(rows)
        pool, r = self.pooled(x, first)
        act = np.maximum(pool + self.bias, 0)
        z = act @ self.out + self.out_bias
        dz = (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
        grads = {"out": act.T @ dz, "out_bias": dz.sum()}
        dpool = dz[:, None] * self.out * (act > 0)
        grads["bias"] = dpool.sum(0)
        touched, dtable = [], []
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for i, w in enumerate(self.widths):
            grad = np.zeros_like(self.filters[w])
            for k in range(self.per_width):
                c = i * self.per_width + k
                hit = np.flatnonzero((r[:, c] == pool[doc, c]) & (dpool[doc, c] != 0))
                hit = hit[np.unique(doc[hit], return_index=True)[1]]
                g = dpool[doc[hit], c]
                for j in range(w):
                    inside = hit + j < first[doc[hit] + 1]
                    at = hit[inside] + j
                    grad[j, :, k] += x[at].T @ g[inside]
                    touched.append(at)
                    dtable.append(g[inside][:, None] * self.filters[w][j, :, k])
            grads[w] = grad
        at, dx = np.concatenate(touched), np.concatenate(dtable)
        for name, g in grads.items():
            state[name] = state.get(name, 1e-6) + g * g
            delta = rate * g / np.sqrt(state[name])
            if name in self.filters:
                self.filters[name] -= delta.astype(np.float32)
            else:
                setattr(self, name, (getattr(self, name) - delta).astype(np.float32))
        slot, inverse = np.unique(rows[:, at], return_inverse=True)
        total = np.zeros((len(slot), self.dim), np.float32)
        for line in inverse.reshape(len(rows), -1):
            np.add.at(total, line, dx)
        memory = state.setdefault("table", np.full((1 << BITS, self.dim), 1e-4, np.float32))
        memory[slot] += total * total
        self.table[slot] -= rate * total / np.sqrt(memory[slot])


def train(texts: list[np.ndarray], y: np.ndarray, epochs: int = 6, batch: int = 32,
          rate: float = 0.05, seed: int = 0) -> ConvNet:
    """Fits a network to table rows per text and 0/1 labels; classes weigh alike."""
    net, rng, state = ConvNet(seed=seed), np.random.default_rng(seed), {}
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    if len(set(y.tolist())) < 2:
        net.out[:] = 0
        net.out_bias = np.float32(np.log(share / (1 - share)))
        return net
    # A text without words says nothing toxic: a few such examples fix that score.
    none = max(8, len(y) // 50)
    texts = [*texts, *[np.empty((1 + len(PREFIXES), 0), np.int32)] * none]
    y = np.concatenate([y, np.zeros(none, y.dtype)])
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            own = order[i:i + batch]
            parts = [texts[d] for d in own]
            first = np.concatenate([[0], np.cumsum([p.shape[1] for p in parts])])
            if first[-1]:
                net.step(np.concatenate(parts, 1), first, y[own], weight[own], state,
                         rate / (1 + 0.3 * epoch))
    return net


def labelled(labels: DataFrame, usable, label: str = "toxic") -> DataFrame:
    """``_id`` and label ``_y`` of every usable id, once."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable) \
        .groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max(label).cast("int").alias("_y"))


def training_rows(docs: DataFrame, labels: DataFrame, usable, sample_rows: int, sample_words: int,
                  label: str = "toxic", text: str = "text", lang: str = "lang") -> list[tuple]:
    """``(table rows, label, lang)`` of the bounded sample of labelled rows."""
    return [r[1:] for r in _sample(docs, labelled(labels, usable, label), sample_rows, sample_words, text, lang)]


def _sample(docs: DataFrame, one: DataFrame, sample_rows: int, sample_words: int, text: str, lang: str) -> list[tuple]:
    """``(id, table rows, label, lang)`` of the sample."""
    # Among the texts that are short enough, and one text per id, the smallest hashes.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(text).cast("string").alias("text"),
                        F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(text).cast("string")).alias("_h"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            short = pa.array(np.flatnonzero(words_of(b.column("text"), ALNUM).counts <= sample_words))
            yield pa.RecordBatch.from_arrays([b.column("_id").take(short), b.column("_h").take(short)], names=["_id", "_h"])

    short = arrow_map(texts.select("_id", "text", "_h"), count, "_id long, _h long").where("_id IS NOT NULL") \
        .groupBy("_id").agg(F.min("_h").alias("_h"))
    known = staged(one.join(short, "_id"), "toxic-labelled")
    order = [F.xxhash64("_id", F.lit("sample")), F.col("_id")]
    ids = [r for v in (0, 1) for r in known.where(F.col("_y") == v).orderBy(*order).limit(sample_rows).collect()]
    frame = docs.sparkSession.createDataFrame([(r._id, r._h, r._y) for r in ids], "_id long, _h long, _y int")
    found = texts.join(F.broadcast(frame), ["_id", "_h"]).select("_id", "text", "lang", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            words = words_of(b.column("text"), ALNUM)
            rows = rows_of(words)
            own = np.arange(words.docs)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(pa.array(own)), b.column("_y").take(pa.array(own)),
                 b.column("lang").take(pa.array(own)),
                 pa.array([rows[:, words.first[d]:words.first[d + 1]].tobytes() for d in own], pa.binary())],
                names=["_id", "_y", "lang", "words"])

    # Repeated rows of one id and text become one before anything is collected.
    rows = arrow_map(found, run, "_id long, _y int, lang string, words binary").groupBy("_id", "_y", "words") \
        .agg(F.min("lang").alias("lang")).select("_id", "_y", "lang", "words").collect()
    return [(r[0], np.frombuffer(r[3], np.int32).reshape(1 + len(PREFIXES), -1), r[1], r[2])
            for r in sorted(rows, key=lambda r: (r[0], bytes(r[3])))]


def best_thresholds(scores: np.ndarray, y: np.ndarray, langs: list, least: int = 20) -> dict:
    """Per language the threshold with the best F1; 0.5 where either class has
    under ``least`` rows."""
    out = {}
    for lang in set(langs):
        own = np.array([x == lang for x in langs])
        s, t = scores[own], y[own]
        out[lang] = 0.5
        if min(t.sum(), len(t) - t.sum()) >= least:
            at = np.unique(np.concatenate([[0.5], (np.sort(s)[1:] + np.sort(s)[:-1]) / 2]))
            f1 = [2 * (t[s >= a].sum()) / max(1, (s >= a).sum() + t.sum()) for a in at]
            best = [a for a, f in zip(at.tolist(), f1) if f == max(f1)]
            out[lang] = min(best, key=lambda a: abs(a - 0.5))
    return out


#: Steps per unit of log odds in which ``thresholds`` sums up scores.
STEPS = 64


def thresholds(scored: DataFrame, least: int = 20) -> dict:
    """``best_thresholds`` of any number of rows ``(lang, score, y)``, exactly.
    Rows are summed up by score; counts above each score come from those of whole
    steps and from the scores of its own step, so no group holds a language."""
    odds = F.log(F.greatest("score", F.lit(1e-300))) - F.log(F.greatest(1 - F.col("score"), F.lit(1e-16)))
    one = scored.groupBy("lang", "score").agg(F.sum(F.col("y").cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")) \
        .withColumn("step", F.floor(odds * STEPS))
    one = staged(one, "toxic-scores")
    steps = one.groupBy("lang", "step").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.max("score").alias("most"))
    up = Window.partitionBy("lang").orderBy(F.desc("step"))  # a bounded number of steps
    whole = Window.partitionBy("lang")
    steps = steps.select(
        F.col("lang").alias("_lang"), F.col("step").alias("_step"),
        (F.sum("pos").over(up) - F.col("pos")).alias("pos_above"), (F.sum("n").over(up) - F.col("n")).alias("n_above"),
        F.lead("most").over(up).alias("below"), F.sum("pos").over(whole).alias("all_pos"),
        F.sum("n").over(whole).alias("all_n"))
    down = Window.partitionBy("lang", "step").orderBy(F.desc("score"))
    rows = one.join(steps, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("step") == F.col("_step"))) \
        .where((F.col("all_pos") >= least) & (F.col("all_n") - F.col("all_pos") >= least))
    rows = rows.select("lang", "score", "n", "all_pos", (F.col("pos_above") + F.sum("pos").over(down)).alias("hits"),
                       (F.col("n_above") + F.sum("n").over(down)).alias("found"),
                       F.coalesce(F.lead("score").over(down), "below").alias("next"))
    # Thresholds between two scores, at one that several rows have, and 0.5.
    at = F.array(F.when(F.col("next").isNotNull(), (F.col("score") + F.col("next")) / 2),
                 F.when(F.col("n") > 1, F.col("score")),
                 F.when((F.col("score") >= 0.5) & ~(F.coalesce("next", F.lit(-1.0)) >= 0.5), F.lit(0.5)))
    f1 = 2 * F.col("hits") / F.greatest(F.lit(1), F.col("found") + F.col("all_pos"))
    found = rows.select("lang", f1.alias("f1"), F.explode(at).alias("at")).where("at IS NOT NULL") \
        .groupBy("lang").agg(F.max(F.struct("f1", -F.abs(F.col("at") - 0.5), -F.col("at"))).alias("best"),
                             F.max("f1").alias("f1"))
    out = {r[0]: 0.5 for r in one.select("lang").distinct().collect()}
    for r in found.collect():
        # Without a hit anywhere all thresholds are alike.
        out[r[0]] = -r[1][2] if r[2] > 0 else 0.5
    return out


def fit(docs: DataFrame, labels: DataFrame, usable=None, sample_rows: int = 3000,
        sample_words: int = 2000, text: str = "text", lang: str = "lang") -> tuple[ConvNet, dict]:
    """The network and the thresholds by language: a fifth of the sample is kept
    out of training, and the thresholds are set by it and by all labelled rows,
    of any length, outside the sample."""
    one = labelled(labels, F.lit(True) if usable is None else usable)
    rows = _sample(docs, one, sample_rows, sample_words, text, lang)
    y = np.array([r[2] for r in rows], np.float32)
    aside = np.arange(len(rows)) % 5 == 4
    net = train([r[1] for r, a in zip(rows, aside) if not a], y[~aside])
    trained = docs.sparkSession.createDataFrame([(r[0],) for r, a in zip(rows, aside) if not a], "_id bigint")
    # Scored where they lie, so that no text is sent to meet its label; rows of one id
    # and text count once, as in the sample.
    rest = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(text).cast("string")).alias("_h"))
    rest = score(rest.where("_id IS NOT NULL"), net, {}, lang="lang").select("row._id", "row._h", "row.lang", "score")
    scored = rest.join(one, "_id").join(F.broadcast(trained), "_id", "left_anti").groupBy("_id", "_h").agg(
        F.min("lang").alias("lang"), F.max("_y").alias("y"), F.max("score").alias("score"))
    return net, thresholds(scored)


def score(docs: DataFrame, net: ConvNet, thresholds: dict, text: str = "text",
          lang: str = "lang") -> DataFrame:
    """``row`` (the document's columns), ``score``, ``threshold`` and ``flagged``."""
    sent = docs.sparkSession.sparkContext.broadcast((net, thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cuts = sent.value
        for batch in text_slices(batches, "text", 1 << 20):
            words = words_of(batch.column("text"), ALNUM)
            s = model.predict(rows_of(words), words.first).astype(np.float64)
            t = np.array([cuts.get(x, 0.5) for x in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(s), pa.array(t), pa.array(s >= t)],
                names=["row", "score", "threshold", "flagged"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
                       F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    kind = rows.schema["row"].dataType.simpleString()
    return arrow_map(rows, run, f"row {kind}, score double, threshold double, flagged boolean")

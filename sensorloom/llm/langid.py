"""Language by sparse multinomial regression on character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import fold, mixed

#: Code points of an n-gram, hashed features, documents of each language the model is fitted on at most
#: (by crc32 of the id), and of all languages.
GRAMS, DIMENSIONS, PER_LANGUAGE, SAMPLE = (1, 2, 3), 1 << 16, 400, 4_000
#: So many times ``PER_LANGUAGE`` documents are looked at to find the first of a language.
SPARE = 1.5
#: One document in so many, those with this remainder, is held out of everything that is learned.
FOLDS, HELD_OUT = 3, 1
#: Steps and penalties of follow-the-regularised-leader.
ALPHA, BETA, LASSO, RIDGE, EPOCHS = 0.5, 1.0, 0.02, 0.01, 3

LETTER = re.compile(r"[^\W\d_]")


def counts(text: str, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased text, words apart by one space, and how often each is."""
    plain = (" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass")
    data = np.frombuffer(plain, "<u4").astype(np.uint64)
    found = []
    code = np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        code = code[: len(data) - n + 1] * np.uint64(0x110001) + data[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            found.append(mixed(code + np.uint64(n << 56)) % np.uint64(dimensions))
    return np.unique(np.concatenate(found), return_counts=True)


@dataclass
class Model:
    """Weights of the n-grams (rows) for each language, bias and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = counts(text, len(self.idf))
        values = (1 + np.log(n)) * self.idf[at]
        return at, values / max(np.sqrt((values * values).sum()), 1e-12)

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not LETTER.search(text or "") or not self.languages:
            return "und", 0.0
        p = softmax(self.logits(*self.vector(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, model: Model) -> None:
    """Follow-the-regularised-leader with elastic net: a weight is zero until its gradients have
    outgrown the lasso."""
    k = len(model.languages)
    z, n = np.zeros((len(model.idf) + 1, k)), np.zeros((len(model.idf) + 1, k))
    random = np.random.default_rng(0)

    def weights(at: np.ndarray) -> np.ndarray:
        here = z[at]
        scale = (BETA + np.sqrt(n[at])) / ALPHA + RIDGE
        return -np.sign(here) * np.maximum(np.abs(here) - LASSO, 0) / scale

    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at, values = rows[i]
            at, values = np.append(at, len(model.idf)), np.append(values, 1.0)  # the last one is the bias
            w = weights(at)
            p = softmax(values @ w)
            p[labels[i]] -= 1
            g = values[:, None] * p[None, :]
            seen = n[at]
            z[at] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / ALPHA * w
            n[at] = seen + g * g
    w = weights(np.arange(len(model.idf) + 1))
    model.weights, model.bias = w[:-1].astype(np.float32), w[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame) -> Model:
    """Learns from ``docs(doc_id, text, lang)`` that are not held out and whose lang is not NULL.

    Document frequencies are those of all of them. The regression takes at most ``PER_LANGUAGE``
    documents of a language and ``SAMPLE`` in all, by crc32 of the id (fewer if a language has many
    rows of few ids), of the ``SAMPLE`` languages with the most documents; a fifth of these sets
    the temperature alone.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    known = known.where(fold("doc_id", FOLDS) != HELD_OUT)
    order = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # the share of each language's ids, by crc32, that holds a few more than are wanted: the ranks
    # are found among these alone, however many documents a language has
    shares = (
        known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE)
        .select("lang", (F.lit(SPARE * PER_LANGUAGE * 2.0**32) / F.col("count")).alias("below"))
    )
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    ids = known.select("lang", order.alias("order"), "doc_id").join(F.broadcast(shares), "lang")
    ids = ids.where("order < below").select("lang", "order", "doc_id").distinct()
    ids = ids.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= PER_LANGUAGE)
    chosen = ids.orderBy("rank", "lang").limit(SAMPLE).select("doc_id", "lang", "rank")
    some = known.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "rank", "text")
    # of rows with the same id and language one is enough
    some = some.groupBy("lang", "rank").agg(F.min("text").alias("text"))

    def frequencies(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in source:
            for text in batch.column("text").to_pylist():
                total[counts(text)[0]] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    # at most DIMENSIONS + 1 sums
    sums = known.select("text").mapInArrow(frequencies, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    df = np.zeros(DIMENSIONS + 1)
    df[np.asarray(table.column("at"))] = np.asarray(table.column("n"))
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    model = Model([], idf.astype(np.float32), np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0))

    def vectors(source: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = [model.vector(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("rank"),
                    pa.array([a.astype(np.int32) for a, _ in made], pa.list_(pa.int32())),
                    pa.array([v.astype(np.float32) for _, v in made], pa.list_(pa.float32())),
                ],
                ["lang", "rank", "at", "value"],
            )

    rows = some.mapInArrow(vectors, "lang string, rank int, at array<int>, value array<float>")
    rows = rows.toArrow().combine_chunks().sort_by([("rank", "ascending"), ("lang", "ascending")])
    langs = rows.column("lang").to_pylist()
    model.languages = sorted(set(langs))
    if not langs:
        return model
    index = {name: i for i, name in enumerate(model.languages)}
    labels = np.array([index[name] for name in langs])
    parts = [rows.column(c).combine_chunks() for c in ("at", "value")]
    data = [(np.asarray(a.values), np.asarray(v.values)) for a, v in zip(*parts)]
    ranks = np.asarray(rows.column("rank"))
    aside = ranks % 5 == 0
    learn = np.flatnonzero(~aside)
    train([data[i] for i in learn], labels[learn], model)
    check = np.flatnonzero(aside)
    logits = np.array([model.logits(*data[i]) for i in check]).reshape(len(check), -1)
    model.temperature = temperature(logits, labels[check])
    return model


def predictions(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs(doc_id, text, lang)``.

    Only the text is an input of a prediction. ``und`` with the score 0 if the text is NULL or has
    no letter, or if nothing could be learned. A row with a NULL doc_id is not held out and not
    learned from. Repeated rows stay. Other columns are ignored; nothing is shuffled but sums.
    """
    model = fit(docs)

    def predict(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double").select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )

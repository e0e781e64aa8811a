"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are all runs of three and four bytes of its letters (ASCII
letters lower-cased, other ASCII read as blanks). Each is hashed to one of
``BUCKETS`` embedding rows; the text is their average, and a linear softmax
gives the language. Embeddings and softmax are trained together by stochastic
gradient descent in numpy, on a bounded sample: ``PER_LANGUAGE`` documents per
language at most, those with the least hashes of key and text; equal rows count
once. A fifth of the sample is kept
out to calibrate: a temperature that fits the probabilities, and the probability
below which a prediction is rejected (``accuracy`` is met above it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from handover.llm import scratch
from handover.llm.batches import chunks, text_bytes
from handover.llm.lm import held_out

BUCKETS = 1 << 15
DIM = 16
PER_LANGUAGE = 800
SAMPLE_ROWS = 160_000  # of all languages together; many languages have fewer rows each
EPOCHS = 4

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def subwords(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every subword."""
    byte = _FOLD[data].astype(np.uint64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    found = []
    for size in (3, 4):
        n = len(byte) - size + 1
        if n <= 0:
            continue
        gram = np.full(n, size, np.uint64)
        blanks = np.zeros(n, np.int8)
        for i in range(size):
            gram = gram << np.uint64(8) | byte[i : n + i]
            blanks += byte[i : n + i] == 0x20
        ok = (row[:n] == row[size - 1 :]) & (blanks <= 1)
        found.append((gram[ok] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15), row[:n][ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]).astype(np.int64), np.concatenate([f[1] for f in found])


class LanguageModel:
    def __init__(self, languages: list[str]):
        self.languages = languages
        rng = np.random.default_rng(7)
        self.embedding = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.softmax = np.zeros((DIM, len(languages)), np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.temperature, self.reject_below = 1.0, 0.0

    def _probabilities(self, logit: np.ndarray) -> np.ndarray:
        z = logit / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def logits(self, bucket: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        per_bucket = self.embedding @ self.softmax
        n = np.maximum(np.bincount(row, minlength=rows), 1)
        return np.stack([np.bincount(row, per_bucket[bucket, k], minlength=rows) / n for k in range(len(self.languages))], axis=1) + self.bias

    def train(self, docs: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> None:
        """SGD over (buckets, counts, language) of each document."""
        rng = np.random.default_rng(seed)
        steps, total = 0, EPOCHS * len(docs)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(docs)):
                bucket, count, y = docs[i]
                if not len(bucket):
                    continue
                share = (count / count.sum()).astype(np.float32)
                rate = np.float32(1.0 * (1 - steps / total) + 0.05)
                steps += 1
                x = share @ self.embedding[bucket]
                p = self._probabilities(x @ self.softmax + self.bias)
                p[y] -= 1
                back = self.softmax @ p
                self.softmax -= rate * np.outer(x, p)
                self.bias -= rate * 0.1 * p
                self.embedding[bucket] -= rate * 20 * np.outer(share, back)

    def calibrate(self, docs: list[tuple[np.ndarray, np.ndarray, int]], accuracy: float) -> None:
        docs = [d for d in docs if len(d[0])]
        if not docs:
            return
        logit = np.stack([(c / c.sum()) @ (self.embedding[b] @ self.softmax) + self.bias for b, c, _ in docs])
        y = np.array([d[2] for d in docs])

        def loss(t: float) -> float:
            self.temperature = t
            return float(-np.log(self._probabilities(logit)[np.arange(len(y)), y] + 1e-9).mean())

        self.temperature = min((2.0 ** (i / 4) for i in range(-16, 17)), key=loss)
        p = self._probabilities(logit)
        order = np.argsort(-p.max(axis=1))
        right = np.cumsum((p.argmax(axis=1) == y)[order]) / np.arange(1, len(y) + 1)
        good = np.flatnonzero(right >= accuracy)
        self.reject_below = 1.0 if not len(good) else 0.0 if good[-1] == len(y) - 1 else float(p.max(axis=1)[order[good[-1]]])


def _sample(docs: DataFrame) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray, int]], list[tuple[np.ndarray, np.ndarray, int]]]:
    """Languages and the counted subwords of the sample: those to train on, those to calibrate on."""
    known = docs.where("text is not null and lang is not null")
    known = known.withColumn("draw", F.xxhash64(F.col("key").cast("string"), F.col("text"), F.lit("draw")))
    draws = scratch.write(known.select("lang", "draw").distinct(), "draws")
    sizes = scratch.write(draws.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())  # the classes of the softmax: all are learned
    if not languages:
        return [], [], []
    each = max(min(PER_LANGUAGE, SAMPLE_ROWS // len(languages)), 1)
    # twice as many as are picked are expected below the first bound, so the order is made of few
    place = F.col("draw") / 2.0**64 + 0.5
    below = draws.join(sizes, "lang").where(place <= 2.0 * each / F.col("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    picks = scratch.write(below.withColumn("nth", nth).where(F.col("nth") <= each).select("lang", "draw"), "picks")
    # one of equal rows, found before the shuffle
    picked = known.join(F.broadcast(picks), ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    picked = picked.select("lang", "text", F.pmod(F.xxhash64("draw", F.lit("part")), F.lit(5)).cast("int").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 1 << 20):
            bucket, row = subwords(*text_bytes(part.column("text")))
            pair, n = np.unique(row * BUCKETS + bucket, return_counts=True)
            cuts = np.searchsorted(pair // BUCKETS, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int32))) for x in (pair % BUCKETS, n)]
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("part"), *lists], names=["lang", "part", "buckets", "counts"])

    rows = picked.mapInArrow(run, "lang string, part int, buckets array<int>, counts array<int>").toArrow()  # SAMPLE_ROWS at most
    at = {k: i for i, k in enumerate(languages)}
    found = []
    for batch in rows.to_batches():
        lists = [batch.column(c) for c in ("buckets", "counts")]
        cuts = lists[0].offsets.to_numpy() - lists[0].offsets[0].as_py()
        bucket, count = (x.flatten().to_numpy() for x in lists)  # views, not Python lists
        for k, p, a, b in zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist(), cuts, cuts[1:]):
            found.append((bucket[a:b], count[a:b].astype(np.float32), at[k], p))
    found.sort(key=lambda d: (d[2], len(d[0]), d[1].sum()))  # the order of rows doesn't matter
    return languages, [d[:3] for d in found if d[3]], [d[:3] for d in found if not d[3]]


def identify(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", folds: int = 5, fold: int = 0, accuracy: float = 0.99) -> DataFrame:
    """(key, held_out, lang_pred, score, rejected), a row for each row of ``docs``.

    Learns from rows with text and language outside the held-out fold (null keys
    count as outside); every language there is learned, from ``PER_LANGUAGE`` rows
    or, with many languages, as many as ``SAMPLE_ROWS`` leaves for each.
    ``und`` with score 0 for null texts and texts without a letter, and for all if
    nothing could be learned. ``score`` is the calibrated probability; a row is
    ``rejected`` if it is below the calibrated bound, or ``und``. Other columns
    are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    languages, train, rest = _sample(docs.where(~held_out(F.col("key"), folds, fold)))
    model = LanguageModel(languages)
    if languages:
        model.train(train or rest)
        model.calibrate(rest or train, accuracy)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in chunks(batches, "text"):
            rows = part.num_rows
            if m.languages:
                p = m._probabilities(m.logits(*subwords(*text_bytes(part.column("text"))), rows))
                best, score = p.argmax(axis=1), p.max(axis=1)
            else:
                best, score = np.zeros(rows, int), np.zeros(rows)
            names = pa.array([m.languages[i] if m.languages else "und" for i in best], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("letters"), names, pa.array(score, pa.float64())], names=["key", "letters", "lang_pred", "score"])

    kind = docs.schema["key"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters")
    done = docs.select("key", "text", letters).mapInArrow(run, f"key {kind}, letters boolean, lang_pred string, score double")
    known = F.col("letters") & (F.col("lang_pred") != "und")
    return done.select(
        F.col("key").alias(key),
        held_out(F.col("key"), folds, fold).alias("held_out"),
        F.when(known, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        (~known | (F.col("score") < model.reject_below)).alias("rejected"),
    )

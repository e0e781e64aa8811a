"""Toxicity by weak supervision.

Voters look for one thing each: a term of a lexicon (a word, or words with a
common beginning) or a fixed pattern. The lexicon is the terms most tied to the
toxic label in a bounded sample of labelled documents. A generative model with
one hidden class estimates from the votes alone how often each voter fires in
either class (its accuracy) and, by the correlation of voters within a class, how
much of a voter's evidence others repeat. Its posteriors are the labels on which
a linear classifier over the votes and their counts is trained. Its margin is then
scaled and shifted to the log odds of the sample's labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handover.llm import scratch
from handover.llm.batches import chunks, codes, text_bytes, words
from handover.llm.lm import held_out

SAMPLE = 4_000  # labelled documents of each class
LEXICON = 200
STEMS = (4, 5, 6)
LEAST_LOG_ODDS = 1.5  # of a lexicon term, two standard errors below its estimate
PATTERNS = ("shouting", "exclaiming", "masked word")
THRESHOLD = 0.3
_RUNS = re.compile(r"[^\W\d_]+")
_MASKS = re.compile(r"[*@#$]{2,}")


def terms(word: str) -> set[str]:
    """Words and beginnings (marked with *) in a white-space delimited word."""
    out = set()
    for run in _RUNS.findall(word.lower()):
        out.add(run)
        out.update(run[:n] + "*" for n in STEMS if len(run) > n)
    return out


def masked(word: str) -> bool:
    """Whether two or more masking signs stand between letters."""
    letter = lambda c: c.isascii() and c.isalpha()
    return any(letter(word[m.start() - 1 : m.start()]) and letter(word[m.end() : m.end() + 1]) for m in _MASKS.finditer(word))


class Voters:
    """Votes of all voters on the texts of a buffer."""

    def __init__(self, lexicon: list[str]):
        self.place = {t: i for i, t in enumerate(lexicon)}
        self.size = len(lexicon) + len(PATTERNS)

    def counts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """How often each voter fired in each text: [texts, voters]."""
        rows, k = len(off) - 1, len(self.place)
        out = np.zeros((rows, self.size), np.float32)
        start, length, row = words(data, off)
        if not len(start):
            return out
        code, distinct = codes(data, start, length)
        hits: list[tuple[int, int]] = []
        has_mask = np.zeros(len(distinct), bool)
        for i, raw in enumerate(distinct.to_pylist()):
            word = raw.decode("utf-8", "replace")
            hits += [(i, p) for t in terms(word) if (p := self.place.get(t)) is not None]
            has_mask[i] = masked(word)
        by_word: dict[int, list[int]] = {}
        for i, p in hits:
            by_word.setdefault(p, []).append(i)
        for p, found in by_word.items():
            fires = np.zeros(len(distinct), bool)
            fires[found] = True
            at = row[fires[code]]
            out[:, p] = np.bincount(at, minlength=rows)
        n = np.maximum(np.bincount(row, minlength=rows), 1)
        per_row = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off])
        upper, lower = per_row((data >= 65) & (data <= 90)), per_row((data >= 97) & (data <= 122))
        out[:, k] = upper > np.maximum(lower, 10)
        out[:, k + 1] = per_row(data == 0x21) * 4 > n
        out[:, k + 2] = np.bincount(row[has_mask[code]], minlength=rows)
        return out


def label_model(votes: np.ndarray, lexicon: int, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the hidden class for rows of 0/1 votes; firing rates [2, voters + 1]; share of own evidence by voter.

    A voter that doesn't fire abstains: terms of one language say nothing on a
    text in another. One more voter, the last, fires if the whole lexicon is silent.
    Classification EM, begun with a majority of the lexicon's voters (the
    first ``lexicon``) against silence. After some rounds the correlations within
    the classes discount voters that repeat others.
    """
    votes = np.concatenate([votes, (votes[:, :lexicon].sum(axis=1, keepdims=True) == 0)], axis=1)
    n, m = votes.shape
    fired = votes[:, :lexicon].sum(axis=1)
    q = np.where(fired > 1, 0.95, np.where(fired > 0, 0.6, 0.02))
    own = np.ones(m)
    rates = np.full((2, m), 0.5)
    for step in range(rounds):
        q = (q > 0.5).astype(float)  # each row counts for its likelier class, or abstaining rows pull the classes together
        weight = np.stack([1 - q, q])
        rates = (weight @ votes + 0.1) / (weight.sum(axis=1, keepdims=True) + 0.2)
        prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
        if step % 10 == 9:
            centred = votes - q[:, None] * rates[1] - (1 - q)[:, None] * rates[0]
            cov = centred.T @ centred / n
            sd = np.sqrt(np.diag(cov)) + 1e-9
            own = 1 / (np.clip(cov / np.outer(sd, sd), 0, 1).sum(axis=1) - np.clip(np.diag(cov) / sd**2, 0, 1) + 1)
        logit = np.log(prior / (1 - prior)) + votes @ (own * np.log(rates[1] / rates[0]))
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q, rates, own


def features(counts: np.ndarray) -> np.ndarray:
    """Votes and their log counts, and the share of firing voters."""
    return np.concatenate([counts > 0, np.log1p(counts), np.log1p((counts > 0).sum(axis=1, keepdims=True))], axis=1).astype(np.float64)


def fit_linear(x: np.ndarray, q: np.ndarray, steps: int = 12, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps; the bias isn't shrunk."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    shrink = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        spread = np.maximum(p * (1 - p), 1e-4)
        w = w + np.clip(np.linalg.solve((x * spread[:, None]).T @ x + np.diag(shrink), x.T @ (q - p) - shrink * w), -3, 3)
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 30, ridge: float = 1e-2) -> tuple[float, float]:
    """Scale and shift of the classifier's margin that make it the log odds of the known labels.

    The ranking is the label model's; only where a score lies is learned here, two
    numbers from weighted labels. With one class only nothing is changed.
    """
    if len(np.unique(label)) < 2:
        return 1.0, 0.0
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weight = weight * len(weight) / weight.sum()
    w, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (label - p)) - ridge * (w - start)
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(2)
        w = w + np.linalg.solve(curve, gradient).clip(-1, 1)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _lexicon(sample: DataFrame) -> list[str]:
    """The terms most tied to the label, by the lower bound of their log odds over documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for part in chunks(batches, "text"):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                for t in set().union(*map(terms, set((text or "").split()))):
                    found.setdefault(t, [0, 0])[toxic] += 1
            if len(found) > 500_000:
                yield _term_rows(found)
                found = {}
        yield _term_rows(found)

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad:
        return []
    rows = sample.select("text", "toxic").mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    least = F.log(t / (bad + 1.0 - t)) - F.log(c / (good + 1.0 - c)) - 2 * F.sqrt(1 / t + 1 / c)
    return [r["term"] for r in rows.where("t >= 3").withColumn("least", least).where(F.col("least") > LEAST_LOG_ODDS).orderBy(F.desc("least"), "term").limit(LEXICON).collect()]


def _term_rows(found: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.int64())], names=["term", "clean", "toxic"])


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", folds: int = 4, fold: int = 2) -> DataFrame:
    """(key, held_out, score, predicted, n_votes), a row for each row of ``docs``.

    Learns only from labels outside the held-out fold, ``SAMPLE`` documents of
    each class at most, picked by a hash of the key. Of rows with one key, the
    text with the least hash is learned from. A document labelled both ways
    counts as toxic; null keys and labels are ignored. Null texts are empty. With
    no toxic label there is no lexicon, and only patterns vote. ``predicted`` is 1
    from score ``THRESHOLD`` on. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("toxic")).where("key is not null and toxic is not null")
    known = known.where(~held_out(F.col("key"), folds, fold)).groupBy("key").agg(F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    draw = F.xxhash64(F.col("key").cast("string"), F.lit("sample"))
    picked = known.where("toxic = 1").orderBy(draw, "key").limit(SAMPLE).unionByName(known.where("toxic = 0").orderBy(draw, "key").limit(SAMPLE))
    rows = docs.where("text is not null").join(F.broadcast(scratch.write(picked, "labelled")), "key")  # 2 x SAMPLE keys at most
    # one row of each key, whatever its number of rows; found before the shuffle
    one = rows.groupBy("key", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("row"))
    sample = scratch.write(one.select("key", "row.text", "toxic"), "toxic-sample")  # 2 x SAMPLE rows at most
    voters = Voters(_lexicon(sample))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 1 << 20):
            counts = voters.counts(*text_bytes(part.column("text")))
            off = np.arange(len(counts) + 1, dtype=np.int32) * voters.size
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(counts.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("toxic"), lists], names=["key", "toxic", "counts"])

    kind = docs.schema["key"].dataType.simpleString()
    rows = sample.select("key", "text", "toxic").mapInArrow(vote, f"key {kind}, toxic int, counts array<float>").toArrow().sort_by("key")  # ordered here: a sort in Spark would run the votes twice
    counts = rows.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, voters.size)
    if len(counts):
        q, _, _ = label_model((counts > 0).astype(np.float64), len(voters.place))
        weights, bias = fit_linear(features(counts), q)
        # the sample holds the classes evenly: each label counts for those of its class that it was drawn from
        toxic = rows.column("toxic").to_numpy()
        of_class = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        share = np.array([of_class.get(c, 0) / max((toxic == c).sum(), 1) for c in (0, 1)])
        scale, shift = calibrate(features(counts) @ weights + bias, toxic, share[toxic])
        weights, bias = weights * scale, bias * scale + shift
    else:
        weights, bias = np.zeros(2 * voters.size + 1), -3.0
    shared = spark.sparkContext.broadcast((voters, weights, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w, b = shared.value
        for part in chunks(batches, "text"):
            counts = v.counts(*text_bytes(part.column("text")))
            p = 1 / (1 + np.exp(-np.clip(features(counts) @ w + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(p), pa.array((counts > 0).sum(axis=1), pa.int64())], names=["key", "score", "n_votes"])

    done = docs.mapInArrow(score, f"key {kind}, score double, n_votes long")
    return done.select(
        F.col("key").alias(key),
        held_out(F.col("key"), folds, fold).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "n_votes",
    )

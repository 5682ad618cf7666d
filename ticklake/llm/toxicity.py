"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed word n-grams (one word, its stem, two words) and skip-grams
(two words with one between), each counted once a text.  The stem is
a word's first bytes: languages that inflect put many endings to one stem.  FTRL-proximal (McMahan et
al., 2013) keeps a learning rate per coordinate and drives most weights to
exactly zero by L1, so the model is a short list that is broadcast.

The model is fitted on a bounded sample of labelled rows (TRAIN_ROWS of each
class, by hash of the id), in one task; texts are turned into features before,
in parallel.  FTRL's L1 shrinks the scores of a small sample, so they are
calibrated (Platt, 1999) on scores that models of the other folds give its rows.
Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Work, handing_back, sliced
from ticklake.llm.shingles import WordHashes, mixed

#: Hashed feature space.
DIM_BITS = 22
#: Rows of each class that the model is fitted on, at most (about).
TRAIN_ROWS = 10_000
EPOCHS = 6
#: Parts of the sample that are scored by models of the others, to calibrate.
FOLDS = 4
#: Rows of a class from which on the scores are calibrated: of fewer, each fold's model sees too few to tell.
CALIBRATED_FROM = 20
#: Texts whose features are handed to Spark together.
SLICE = 500
#: Bytes of a word's stem.
STEM = 4

_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def features(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Feature numbers of a text, in order and with repeats; null has none.
    Words are runs of letters and digits, in lower case."""
    found = (text or "").lower().encode().translate(_SPACE).split()
    words = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    stems = np.fromiter(map(hashes.__getitem__, [w[:STEM] for w in found if len(w) > STEM]), np.uint64) + np.uint64(1)
    odd = np.uint64(0x9E3779B97F4A7C15)
    pairs = mixed(words[:-1] * odd + words[1:])
    skips = mixed(words[:-2] * odd + words[2:] + np.uint64(1)) if len(words) > 2 else words[:0]
    return (np.concatenate([words, mixed(stems), pairs, skips]) >> np.uint64(64 - DIM_BITS)).astype(np.int32)


@dataclass
class Ftrl:
    """FTRL-proximal: rate alpha / (beta + sqrt(sum of squared gradients)) per
    coordinate, L1 and L2 strengths; coordinate 2**DIM_BITS is the bias."""

    alpha: float = 2.0
    beta: float = 0.3
    l1: float = 4.0
    l2: float = 0.01

    def __post_init__(self):
        self.z = np.zeros((1 << DIM_BITS) + 1)
        self.n = np.zeros((1 << DIM_BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / step)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, float]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights that aren't zero, from (features, label)."""
    model, bias = Ftrl(), np.array([1 << DIM_BITS])
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            model.learn(np.concatenate([rows[i][0], bias]), rows[i][1])
    at = np.flatnonzero((model.z > model.l1) | (model.z < -model.l1))
    return at.astype(np.int64), model.weights(at)


def calibration(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores (log odds) into those under which the
    labels are likeliest, by Newton steps.  Labels count as a little less than
    certain, by the size of their class, and a standard normal prior around the
    identity keeps a few rows, or classes set apart in full, from a steep line."""
    toxic = labels.sum()
    wanted = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (len(labels) - toxic + 2))
    x = np.stack([np.clip(scores, -35, 35), np.ones(len(scores))], 1)
    line, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - wanted * z).sum() + ((at - start) ** 2).sum() / 2)

    for _ in range(100):
        p = sigmoid(x @ line)
        slope = x.T @ (p - wanted) + line - start
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
        while loss(line - step) > loss(line) and np.abs(step).max() > 1e-9:
            step = step / 2
        line = line - step
        if np.abs(step).max() < 1e-7:
            break
    return max(float(line[0]), 0.0), float(line[1])


def calibrated_fit(rows: list[tuple[np.ndarray, float]], folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray]:
    """As `fit`, scaled by the calibration of what the models of the other
    folds say of each row.  The folds take the rows of each class in turn; with
    fewer than CALIBRATED_FROM rows of a class the scores stay as they are."""
    at, weight = fit(rows)
    labels = np.array([y for _, y in rows])
    if min(labels.sum(), len(labels) - labels.sum()) < CALIBRATED_FROM:
        return at, weight
    fold = np.empty(len(rows), int)
    for y in (0, 1):
        fold[labels == y] = np.arange((labels == y).sum()) % folds
    scores, dense = np.empty(len(rows)), np.zeros((1 << DIM_BITS) + 1)
    for k in range(folds):
        other_at, other = fit([r for r, f in zip(rows, fold) if f != k])
        dense[other_at] = other
        for i in np.flatnonzero(fold == k):
            scores[i] = dense[rows[i][0]].sum() + dense[-1]
        dense[other_at] = 0
    slope, offset = calibration(scores, labels)
    bias = at == 1 << DIM_BITS
    weight = weight * slope
    return np.append(at[~bias], 1 << DIM_BITS), np.append(weight[~bias], weight[bias].sum() + offset)


def _class_counts(labels: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def _training_rows(work: Work, docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(id, label, text) of the sample, and the log odds to add to those of a
    model fitted on it: log of the toxic rows a sampled one stands for, less
    that of the clean ones."""
    labels = labels.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    labels = work(labels, "toxicity_labels")
    counts = _class_counts(labels)
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, TRAIN_ROWS / n))).otherwise(share)
    chosen = labels.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))
    sampled = _class_counts(chosen) if max(counts.values(), default=0) > TRAIN_ROWS else counts
    shift = math.log(counts[1] / sampled[1]) - math.log(counts[0] / sampled[0]) if len(sampled) == 2 else 0.0
    return docs.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), shift  # about 2 * TRAIN_ROWS ids


def train(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """Weights (at, weight) that aren't zero, from documents (id, text) and
    labels (id, label), and that of the bias; without rows of both classes
    there are none."""

    @handing_back
    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in sliced(batches, SLICE):
            found = [np.unique(features(t, hashes)) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"].to_numpy(), "label": batch["label"].to_numpy(), "features": found})

    @handing_back
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(np.asarray(f), float(y)) for batch in batches for f, y in zip(batch["features"], batch["label"])]
        if len({y for _, y in rows}) == 2:
            at, weight = calibrated_fit(rows)
            bias = at == 1 << DIM_BITS
            at, weight = np.append(at[~bias], 1 << DIM_BITS), np.append(weight[~bias], weight[bias].sum() + shift)
            yield pd.DataFrame({"at": at, "weight": weight})

    work = Work(docs.sparkSession)
    sample, shift = _training_rows(work, docs, labels)
    sample = sample.mapInPandas(featurize, "id long, label int, features array<int>")
    one = sample.repartition(1).sortWithinPartitions("id")  # the bounded sample
    weights = one.mapInPandas(learn, "at long, weight double").toPandas()
    work.end()
    return weights


def scored(docs: DataFrame, weights: pd.DataFrame, into: str = "score", text_col: str = "text") -> DataFrame:
    """`docs` with a score from 0 to 1; an empty or null text gets the score
    of the bias alone, as any text without known features; without a model the
    score is 0.  Repeated rows score alike; a column `into` is replaced."""
    dense = np.zeros((1 << DIM_BITS) + 1, np.float32)
    dense[weights["at"].to_numpy(np.int64)] = weights["weight"].to_numpy(float)
    at = np.flatnonzero(dense).astype(np.int32)  # sparse: what is sent
    held = docs.sparkSession.sparkContext.broadcast((at, dense[at]))

    @F.pandas_udf("double")
    @handing_back
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, values = held.value
        table, hashes = np.zeros((1 << DIM_BITS) + 1, np.float32), WordHashes()
        table[at] = values
        for texts in batches:
            out = np.zeros(len(texts))
            for i, text in enumerate(texts):
                found = features(text, hashes)
                out[i] = table[np.unique(found[table[found] != 0])].sum(dtype=np.float64)
            yield pd.Series(sigmoid(out + float(table[-1])) if len(at) else out)

    return docs.withColumn(into, score(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """`docs` with held_out, score and predicted (1 if score >= threshold).

    Rows whose crc32(id as text) mod 3 is 1 are held out of the fit (a null id
    counts as held out).  Labels that are null or not 0 or 1 are ignored, of
    several labels of an id the largest counts.  Columns of these names are
    replaced, all rows are returned; an empty table gives none.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))
    fitted_on = labels.where(~held_out).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    weights = train(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), fitted_on)
    out = scored(docs.withColumn("held_out", held_out), weights, "score", text_col)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

r"""Quality classifier learned from positives and unlabelled text.

A small network scores how a whole text looks (``shape`` of the text, repeated
words, windows and lines). It minimises the non-negative unbiased risk: trusted
positives stand for good text, unlabelled documents for the web, and the class
prior is the share of good text among the documents labelled for learning. The
raw score is then calibrated to a probability on those labelled rows.

Fitting uses at most ``SAMPLE`` rows of each kind, chosen by a hash of the key;
every document is scored. Null text counts as empty. Without any label the prior
alone is the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import line_crf
from staylens.llm import shape as S
from staylens.llm import words as W
from staylens.session import configure, scratch_path

SAMPLE = 20_000
HIDDEN, ROUNDS, RATE = 16, 400, 0.02
THRESHOLD = 0.3
FOLDS, HELD = 5, 0
N_FEATURES = S.N_SHAPE + 6


def text_features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES numbers for each text."""
    n = len(off) - 1
    start, end, text = W.spans(data, off)
    n_words = np.bincount(text, minlength=n)
    value = W.hashes(W.LOWER[data], start, end)
    again, _ = S.repeated(value, text, n, 5)
    key = np.unique(W.mix(value ^ W.mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    some = np.maximum(n_words, 1)
    same = np.zeros(len(value), bool)
    same[1:] = (value[1:] == value[:-1]) & (text[1:] == text[:-1])
    owner, lines, dup, _ = line_crf.line_table(data, off)
    n_lines = np.maximum(np.bincount(owner, minlength=n), 1)
    more = [
        np.bincount(text[key], minlength=n) / some,
        np.bincount(text[again], minlength=n) / some,
        np.bincount(text[same], minlength=n) / some,
        np.bincount(owner[dup], minlength=n) / n_lines,
        np.bincount(owner, weights=lines[:, 1] > 0.6, minlength=n) / n_lines,
        np.bincount(owner, weights=lines[:, 5] > 0.2, minlength=n) / n_lines,
    ]
    return np.concatenate((S.shape(data, off, n_words), np.stack(more, 1)), axis=1)


class Scorer:
    """A fitted classifier: standardise, one hidden layer, calibrate."""

    def __init__(self, mean, scale, layers, slope: float, shift: float):
        self.mean, self.scale, self.layers, self.slope, self.shift = mean, scale, layers, slope, shift

    def margin(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, known: np.ndarray, label: np.ndarray, seed: int = 7) -> Scorer:
    """Non-negative risk over positives and unlabelled rows, then calibration on (known, label)."""
    width = unlabelled.shape[1]
    every = np.concatenate((positive, unlabelled))
    mean, scale = (every.mean(0), every.std(0) + 0.05) if len(every) else (np.zeros(width), np.ones(width))
    random = np.random.default_rng(seed)
    layers = [random.normal(0, 0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, 0.5, HIDDEN), np.zeros(1)]
    model = Scorer(mean, scale, layers, 0.0, float(np.log(np.clip(prior, 1e-3, 0.999) / (1 - np.clip(prior, 1e-3, 0.999)))))
    if not len(positive) or not len(unlabelled):
        return model
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    xp, xu = (positive - mean) / scale, (unlabelled - mean) / scale
    for i in range(1, ROUNDS + 1):
        hp, hu = np.tanh(xp @ layers[0] + layers[1]), np.tanh(xu @ layers[0] + layers[1])
        zp, zu = hp @ layers[2] + layers[3], hu @ layers[2] + layers[3]
        sp, su = _sigmoid(zp), _sigmoid(zu)  # sigmoid loss: l(z, +) = 1 - s, l(z, -) = s
        negative = su.mean() - prior * sp.mean()
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        if negative >= 0:
            gp, gu = -2 * prior * dp, du
        else:  # the negative part of the risk may not fall below zero: step back on it
            gp, gu = prior * dp, -du
        grads = [xp.T @ (gp[:, None] * layers[2] * (1 - hp**2)) + xu.T @ (gu[:, None] * layers[2] * (1 - hu**2))]
        grads.append(((gp[:, None] * layers[2]) * (1 - hp**2)).sum(0) + ((gu[:, None] * layers[2]) * (1 - hu**2)).sum(0))
        grads += [hp.T @ gp + hu.T @ gu, np.array([gp.sum() + gu.sum()])]
        for k, g in enumerate(grads):
            g = g + 1e-5 * layers[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            layers[k] = layers[k] - RATE * (first[k] / (1 - 0.9**i)) / (np.sqrt(second[k] / (1 - 0.999**i)) + 1e-8)
        model.layers = layers
    if len(label) and label.min() != label.max():
        z = model.margin(known)
        slope, shift = 1.0, 0.0
        for _ in range(50):  # Newton steps of a two-parameter logistic fit
            p = _sigmoid(slope * z + shift)
            w = p * (1 - p) + 1e-6
            gradient = np.array([((label - p) * z).sum() - 1e-2 * slope, (label - p).sum()])
            hessian = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
            move = np.linalg.solve(hessian, gradient)
            slope, shift = slope + np.clip(move[0], -2, 2), shift + np.clip(move[1], -2, 2)
        model.slope, model.shift = float(slope), float(shift)
    else:
        model.slope, model.shift = 1.0, 0.0
    return model


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row of ``docs``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            values = text_features(*W.raw(batch.column("text"))).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, N_FEATURES, dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, features array<float>")


def learn(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on the learning folds of featured ``rows``; ``labels`` has doc_id, quality."""
    fold = W.remainder(F.col("doc_id"), FOLDS) != HELD
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & fold).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    seen = rows.where(fold & F.col("doc_id").isNotNull()).join(known, "doc_id", "left")
    total = {r["quality"]: r["n"] for r in seen.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n_known = sum(n for q, n in total.items() if q is not None)
    # Without unlabelled rows the labelled ones stand for the web.
    web = F.col("quality").isNull() if total.get(None) else F.lit(True)
    n_web = total.get(None) or n_known

    def taken(condition, n, salt):
        part = seen.where(condition & W.by_share(F.col("doc_id"), W.sample_share(n, sample), salt)).orderBy("doc_id").limit(2 * sample).select("features", "quality").toPandas()
        return np.array(part["features"].tolist(), float).reshape(-1, N_FEATURES), part["quality"].to_numpy(float)

    x, y = taken(F.col("quality").isNotNull(), n_known, 1)
    u, _ = taken(web, n_web, 2)
    y = (y > 0).astype(float)
    prior = float(y.mean()) if len(y) else 0.5
    return fit(x[y > 0], u, prior, x, y)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    path = scratch_path(spark, "quality-features")
    featured(W.documents(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    model = learn(rows, W.documents(spark, sf_dir, "labels"))

    def score(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = rows.mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (W.remainder(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def good(docs: DataFrame, model: Scorer) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""

    def keep(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            yield batch.filter(pa.array(model.score(text_features(*W.raw(batch.column("text")))) >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)

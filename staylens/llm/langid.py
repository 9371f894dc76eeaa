r"""Language identification with interpolated Kneser-Ney character models.

One order-4 character model per language, over lower-cased letters; a word starts
and ends with a space and a context does not reach past it. All probabilities and
back-off weights stand in arrays sorted by the hash of their n-gram, one column
per language. The answer is the language of the lowest cross-entropy per
character. Its confidence is calibrated on learning rows that the models did not
see, and a low one marks the row as rejected.

The models are fitted on at most about ``PER_LANGUAGE`` documents of a language,
chosen by a hash of the key; whole texts of all documents are scored. A text that
is null or has no letter is ``und`` with score 0, and so is every text when there
is nothing to learn from. Equal cross-entropies go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.session import configure

ORDER = 4
PER_LANGUAGE = 2_000
CALIBRATION_FOLD = 5  # every fifth learning row calibrates
REJECT_BELOW = 0.5
FOLDS, HELD = 3, 1
GRAM = "lang string, c3 int, c2 int, c1 int, c0 int, n bigint"

# Runs of ASCII letters and of all non-ASCII bytes; other code points are sorted out after decoding.
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def distinct_words(data: np.ndarray, off: np.ndarray):
    """The texts' letter runs: text of each, which distinct run it is, and the code points of the distinct runs."""
    start, end, text = W.spans(data, off, _LETTERS)
    _, first, which = np.unique(W.hashes(W.LOWER[data], start, end), return_index=True, return_inverse=True)
    whole = data.tobytes()
    joined = b" ".join([whole[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]) + b" "
    points = np.frombuffer(joined.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.cumsum(points == 32) - (points == 32)
    for point in np.unique(points[points >= 128]).tolist():
        if not chr(point).isalpha():
            points = np.where(points == point, 32, points)
    return text, which, points, owner, len(first)


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER code points at every letter and word end, and the places of these; a context ends at a space."""
    columns = [points]
    for _ in range(ORDER - 1):
        before = np.concatenate(([32], columns[-1][:-1]))
        columns.append(before)
    for i in range(2, ORDER):
        columns[i] = np.where((columns[i - 1] == 32) | (columns[i - 1] == 0), 0, columns[i])
    counts = (points != 32) | (columns[1] != 32)
    return np.stack(columns[::-1], 1)[counts], np.flatnonzero(counts)


def code(gram: np.ndarray) -> np.ndarray:
    """Hash of each row of code points."""
    out = np.zeros(len(gram), np.uint64)
    for i in range(gram.shape[1]):
        out = W.mix(out + gram[:, i].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return out


class Models:
    """Kneser-Ney models of all languages: for each order, sorted n-gram hashes with log-probabilities and sorted context hashes with log back-off weights."""

    def __init__(self, languages: list[str], gram: np.ndarray, language: np.ndarray, count: np.ndarray):
        self.languages = languages
        n = len(languages)
        levels = []  # (gram, count per language) from order 1 up; lower orders count distinct predecessors
        top = _table(gram, language, count, n)
        for order in range(ORDER, 0, -1):
            levels.insert(0, top)
            if order > 1:
                rows, lang = np.nonzero(top[1])
                top = _table(top[0][rows][:, 1:], lang, np.ones(len(rows)), n)
        self.floor = -np.log(len(levels[0][0]) + 1.0)
        self.tables, self.backoff = [], []
        below = np.full((len(levels[0][0]), n), np.exp(self.floor))
        for order, (rows, counts) in enumerate(levels, 1):
            context, place = np.unique(code(rows[:, :-1]), return_inverse=True)
            total, kinds = np.zeros((len(context), n)), np.zeros((len(context), n))
            np.add.at(total, place, counts)
            np.add.at(kinds, place, counts > 0)
            ones, twos = (counts == 1).sum(0), (counts == 2).sum(0)
            discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.95)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            if order > 1:
                below = np.exp(self._look(order - 1, code(rows[:, 1:])))
            p = np.maximum(counts - discount, 0) / np.maximum(total, 1)[place] + weight[place] * below
            key = code(rows)
            by = np.argsort(key)
            self.tables.append((key[by], np.log(p[by]).astype(np.float32)))
            self.backoff.append((context, np.log(weight).astype(np.float32)))

    def _look(self, order: int, key: np.ndarray) -> np.ndarray:
        keys, logs = self.tables[order - 1]
        return logs[np.searchsorted(keys, key)].astype(float)

    def score(self, gram: np.ndarray) -> np.ndarray:
        """Log-probability of every row's last code point given the others, one column per language."""
        out = np.zeros((len(gram), len(self.languages)))
        rest = np.arange(len(gram))
        for order in range(ORDER, 0, -1):
            keys, logs = self.tables[order - 1]
            key = code(gram[rest, ORDER - order :])
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            out[rest[hit]] += logs[at[hit]]
            rest = rest[~hit]
            if not len(rest):
                return out
            contexts, weights = self.backoff[order - 1]
            key = code(gram[rest, ORDER - order : -1])
            at = np.minimum(np.searchsorted(contexts, key), len(contexts) - 1)
            known = contexts[at] == key
            out[rest[known]] += weights[at[known]]
        out[rest] += self.floor
        return out

    def texts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-probability per character and language, and letters, of each text."""
        n = len(off) - 1
        text, which, points, owner, distinct = distinct_words(data, off)
        gram, place = grams(points)
        logs = self.score(gram)
        mine = owner[place]
        total = np.stack([np.bincount(text, weights=np.bincount(mine, weights=logs[:, k], minlength=distinct)[which], minlength=n) for k in range(logs.shape[1])], 1)
        size = np.bincount(text, weights=np.bincount(mine, minlength=distinct)[which], minlength=n)
        letters = np.bincount(text, weights=np.bincount(owner[points != 32], minlength=distinct)[which], minlength=n)
        return total / np.maximum(size, 1)[:, None], letters


def _table(gram, language, count, n):
    key, first, place = np.unique(code(gram), return_index=True, return_inverse=True)
    counts = np.zeros((len(key), n))
    np.add.at(counts, (place, language), count)
    return gram[first], counts


def evidence(mean: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language, and its lead over the next in nats, damped for long texts."""
    best = mean.argmax(1)
    lead = np.sort(mean, 1)
    gap = lead[:, -1] - lead[:, -2] if mean.shape[1] > 1 else np.ones(len(mean))
    return best, gap * np.sqrt(letters)


def count_grams(docs: DataFrame) -> DataFrame:
    """Character n-gram counts by language over (lang, text)."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            lang = batch.column("lang").to_pylist()
            for name in sorted(set(lang)):
                part = batch.filter(pa.array([x == name for x in lang]))
                _, which, points, owner, distinct = distinct_words(*W.raw(part.column("text")))
                gram, place = grams(points)
                weight = np.bincount(which, minlength=distinct)[owner[place]]
                _, first, inverse = np.unique(code(gram), return_index=True, return_inverse=True)
                n = np.bincount(inverse, weights=weight).astype(np.int64)
                columns = [pa.array([name] * len(first), pa.string()), *(pa.array(gram[first, i].astype(np.int32)) for i in range(ORDER)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "c3", "c2", "c1", "c0", "n"])

    return docs.select("lang", "text").mapInArrow(read, GRAM).groupBy("lang", "c3", "c2", "c1", "c0").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE):
    """Models and their calibration from the learning folds of (doc_id, text, lang); None without any."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (W.remainder(F.col("doc_id"), FOLDS) != HELD))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(W.sample_share(totals[x], per_language))) for x in languages])
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share * 1_000_000)
    held = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(CALIBRATION_FOLD)) == 0
    counted = count_grams(rows.where(~held)).toPandas()
    if not len(counted):
        counted = count_grams(rows).toPandas()
    if not len(counted):
        return None
    seen = sorted(set(counted["lang"]))
    models = Models(seen, counted[["c3", "c2", "c1", "c0"]].to_numpy(np.int64), counted["lang"].map(seen.index).to_numpy(), counted["n"].to_numpy(float))

    def lead(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            mean, letters = models.texts(*W.raw(batch.column("text")))
            best, gap = evidence(mean, letters)
            right = [float(models.languages[b] == x) for b, x in zip(best, batch.column("lang").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(gap), pa.array(right)], names=["gap", "good"])

    sample = rows.where(held).select("lang", "text").mapInArrow(lead, "gap double, good double").toPandas().sort_values(["gap", "good"])
    return models, calibrate(sample["gap"].to_numpy(), sample["good"].to_numpy())


def calibrate(gap: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of being right on the lead; two made-up rows keep it finite."""
    gap, good = np.concatenate((gap, [0.0, 10.0])), np.concatenate((good, [0.0, 1.0]))
    slope, shift = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * gap + shift, -30, 30)))
        w = p * (1 - p) + 1e-6
        gradient = np.array([((good - p) * gap).sum() - 0.01 * slope, (good - p).sum() - 0.01 * shift])
        hessian = np.array([[(w * gap * gap).sum() + 0.01, (w * gap).sum()], [(w * gap).sum(), w.sum() + 0.01]])
        move = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        slope, shift = max(0.01, slope + move[0]), shift + move[1]
    return slope, shift


def identify(docs: DataFrame, learned) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of ``docs``; only the text is read."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            n = batch.num_rows
            names, score = np.full(n, "und", object), np.zeros(n)
            if learned:
                models, (slope, shift) = learned
                mean, letters = models.texts(*W.raw(batch.column("text")))
                best, gap = evidence(mean, letters)
                some = letters > 0
                names[some] = np.array(models.languages, object)[best[some]]
                score = np.where(some, 1 / (1 + np.exp(-np.clip(slope * gap + shift, -30, 30))), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(score < REJECT_BELOW)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, lang_pred string, score double, rejected boolean")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = W.documents(spark, sf_dir)
    return identify(docs, learn(docs)).withColumn("held_out", W.remainder(F.col("doc_id"), FOLDS) == HELD)

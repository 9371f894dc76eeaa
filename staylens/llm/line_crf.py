r"""Quality rules with line labelling: a linear-chain conditional random field.

Each line of a text is content or boilerplate. The field scores a line by how it
looks (``shape``, whether it repeats an earlier line) and by its neighbour's
label; Viterbi decoding labels all lines of the whole text, and the share of word
characters on content lines decides whether the text stays. Texts that fail the
base rules (too short, too repetitive) go without asking the field.

The field is trained by maximum likelihood on a bounded sample of labelled
documents (``TRAIN_DOCS``, ``TRAIN_LINES``), each distinct text of a key once and a chain of its own. Lines of good documents count as content, lines of
bad ones and repeated lines as boilerplate. Without labels of both kinds every
line is content. Null text has no words and fails the base rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import shape as S
from staylens.llm import words as W
from staylens.session import configure

TRAIN_DOCS, TRAIN_LINES = 3_000, 400_000  # lines: 40 MB on the driver
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
MIN_CONTENT = 0.5
N_FEATURES = S.N_SHAPE + 2
OUT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, content_share double, base_failed boolean, kept boolean"


def line_table(data: np.ndarray, off: np.ndarray):
    """Lines that hold a word: their offsets, texts, features, whether they repeat an earlier one, word characters."""
    cut = np.flatnonzero(data == 10)
    edge = np.unique(np.concatenate((off, cut, cut + 1)))
    start, end = edge[:-1], edge[1:]
    words, _, _ = W.spans(data, off)
    n_words = np.searchsorted(words, end) - np.searchsorted(words, start)
    keep = n_words > 0
    start, end, n_words = start[keep], end[keep], n_words[keep]
    text = np.searchsorted(off, start, side="right") - 1
    first, second = (W.hashes(data, start, end, seed) for seed in (0, 1))
    order = np.lexsort((start, second, first, text))
    same = np.zeros(len(order), bool)
    same[1:] = (text[order][1:] == text[order][:-1]) & (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    dup = np.zeros(len(order), bool)
    dup[order] = same
    where, at = W.flat(start, end)
    own = np.concatenate((at, [len(where)])).astype(np.int64)
    part = data[where]
    features = np.concatenate((S.shape(part, own, n_words), dup[:, None], np.ones((len(start), 1))), axis=1)
    return text, features, dup, S.code_points(part, own, W.SOLID)


def chains(text: np.ndarray, n_texts: int):
    """Texts by falling number of lines, how many lines each has, and the first line of each."""
    count = np.bincount(text, minlength=n_texts)
    order = np.argsort(-count, kind="stable")
    return order, count[order], (np.cumsum(count) - count)[order]


def viterbi(emission: np.ndarray, step: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Best labels (1: content) of all lines; ``emission`` favours content, ``step[a, b]`` label b after a."""
    label = np.ones(len(text), np.int8)
    order, count, first = chains(text, n_texts)
    longest = int(count[0]) if len(count) else 0
    alive = [int(np.searchsorted(-count, -t, side="left")) for t in range(longest)]  # texts with more than t lines
    back = []
    score = np.zeros((len(order), 2))
    for t in range(longest):
        n = alive[t]
        gain = emission[first[:n] + t]
        if t:
            through = score[:n, :, None] + step[None]
            came = through.argmax(1)
            back.append(came.astype(np.int8))
            score[:n] = through.max(1)
        score[:n, 1] += gain
    now = score.argmax(1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        label[first[:n] + t] = now[:n]
        if t:
            now[:n] = back[t - 1][np.arange(n), now[:n]]
    return label


def train(features: np.ndarray, label: np.ndarray, text: np.ndarray, n_texts: int, rounds: int = 120) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood weights and steps, by forward-backward and gradient ascent (Adam)."""
    weight, step = np.zeros(features.shape[1]), np.zeros((2, 2))
    if not len(label) or label.min() == label.max():
        weight[-1] = 8.0
        return weight, step
    order, count, first = chains(text, n_texts)
    longest = int(count[0])
    alive = [int(np.searchsorted(-count, -t, side="left")) for t in range(longest)]
    follows = text[1:] == text[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][follows], label[1:][follows]), 1)
    size, momentum, scale = len(label), np.zeros(len(weight) + 4), np.zeros(len(weight) + 4)
    for i in range(1, rounds + 1):
        gain = features @ weight
        forward = [None] * longest
        for t in range(longest):
            n = alive[t]
            e = np.stack((np.zeros(n), gain[first[:n] + t]), 1)
            forward[t] = e if t == 0 else e + np.logaddexp(forward[t - 1][:n, 0, None] + step[0], forward[t - 1][:n, 1, None] + step[1])
        marginal, expected = np.zeros(size), np.zeros((2, 2))
        behind = np.zeros((len(order), 2))
        for t in range(longest - 1, -1, -1):
            n = alive[t]
            joint = forward[t] + behind[:n]
            total = np.logaddexp(joint[:, 0], joint[:, 1])
            marginal[first[:n] + t] = np.exp(joint[:, 1] - total)
            if t:
                ahead = behind[:n] + np.stack((np.zeros(n), gain[first[:n] + t]), 1)
                pair = forward[t - 1][:n, :, None] + step[None] + ahead[:, None, :] - total[:, None, None]
                expected += np.exp(pair).sum(0)
                behind[:n] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
        slope = np.concatenate((features.T @ (label - marginal), (seen - expected).ravel())) / size
        slope -= 1e-4 * np.concatenate((weight, step.ravel()))
        momentum = 0.9 * momentum + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        move = 0.2 * (momentum / (1 - 0.9**i)) / (np.sqrt(scale / (1 - 0.99**i)) + 1e-8)
        weight, step = weight + move[:-4], step + move[-4:].reshape(2, 2)
    return weight, step


def training_texts(docs: DataFrame, labels: DataFrame, wanted: int, most_lines: int) -> DataFrame:
    """(doc_id, digest, text, quality): distinct texts of the sampled keys, with ``most_lines`` lines together at most.

    Which texts are taken depends on keys and contents only. Labels of one key that
    conflict count as good. A text with more than a hundredth of the lines is left out.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = W.sample_share(known.count(), wanted)
    some = known.where(W.by_share(F.col("doc_id"), share, 9)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * wanted)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(some), "doc_id").withColumn("digest", F.md5("text"))
    size = F.size(F.split("text", "\n", -1))
    sized = rows.select("doc_id", "digest", size.alias("size")).distinct().where(F.col("size") <= max(most_lines // 100, 1))
    first = sized.orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(2 * wanted).collect()
    taken, total = [], 0
    for r in first:
        total += r["size"]
        if total > most_lines:
            break
        taken.append((r["doc_id"], r["digest"]))
    chosen = docs.sparkSession.createDataFrame(taken, "doc_id bigint, digest string")
    return rows.join(F.broadcast(chosen), ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(F.max("text").alias("text"), F.max("quality").alias("quality"))


def training_lines(docs: DataFrame, labels: DataFrame, wanted: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES):
    """Features and weak labels of the lines of about ``wanted`` labelled documents (twice that at most), by key and content."""
    packed = training_texts(docs, labels, wanted, most_lines)

    def lines(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            data, off = W.raw(batch.column("text"))
            text, features, dup, _ = line_table(data, off)
            label = ((batch.column("quality").to_numpy(zero_copy_only=False)[text] > 0) & ~dup).astype(np.int8)
            edge = np.searchsorted(text, np.arange(batch.num_rows + 1))
            rows = [(label[a:b].tobytes(), features[a:b].astype(float).tobytes()) for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), *(pa.array(c, pa.binary()) for c in zip(*rows))], names=["doc_id", "digest", "label", "features"]
            )

    rows = packed.mapInArrow(lines, "doc_id bigint, digest string, label binary, features binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["digest"]))
    label = np.concatenate([np.zeros(0, np.int8), *(np.frombuffer(r["label"], np.int8) for r in rows)]).astype(np.int64)
    features = np.concatenate([np.zeros(0), *(np.frombuffer(r["features"]) for r in rows)]).reshape(-1, N_FEATURES)
    text = np.repeat(np.arange(len(rows)), [len(r["label"]) for r in rows])
    return features, label, text, len(rows)


def judge(docs: DataFrame, weight: np.ndarray, step: np.ndarray, min_content: float = MIN_CONTENT) -> DataFrame:
    """Counts, content share and verdict for every row of ``docs`` (doc_id, text)."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            data, off = W.raw(batch.column("text"))
            n = batch.num_rows
            start, end, text = W.spans(data, off)
            n_words = np.bincount(text, minlength=n)
            again, _ = S.repeated(W.hashes(data, start, end), text, n, REPEAT_WINDOW)
            n_again = np.bincount(text[again], minlength=n)
            owner, features, dup, size = line_table(data, off)
            label = viterbi(features @ weight, step, owner, n)
            total = np.bincount(owner, weights=size, minlength=n)
            share = np.bincount(owner, weights=size * label, minlength=n) / np.maximum(total, 1)
            failed = (n_words < MIN_WORDS) | (100 * n_again > MAX_REPEAT_PERCENT * n_words)
            columns = [n_words, S.code_points(data, off, W.SOLID), S.symbols(data, off), np.bincount(owner[dup], minlength=n), n_again]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in columns), pa.array(share), pa.array(failed), pa.array(~failed & (share >= min_content))],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(read, OUT)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = W.documents(spark, sf_dir)
    weight, step = train(*training_lines(docs, W.documents(spark, sf_dir, "labels")))
    return judge(docs, weight, step)

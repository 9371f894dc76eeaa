r"""Toxicity classifier: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a whole text are densities of three lexicons, how often their words
stand near a second-person word, the densest stretch of them, capitals, punctuation,
and obfuscation: lexicon words that appear only once digits, symbols and stretched
letters are undone, words of single letters, masked words. They are narrow rows,
stored once; Spark's tree and isotonic learners then run on them as jobs.

A fourth lexicon is learnt: stems and words that stand in the toxic learning texts and
hardly in the others (:func:`learnt_lexicon`), for insults no fixed list holds. Its counts
come from at most about ``LEXICON_SAMPLE`` labelled rows.

Learning uses at most about ``SAMPLE`` labelled rows, chosen by a hash of the key;
equal texts count once, with the majority's label, so that a group of copies weighs
as one. Two thirds fit the trees, the others the calibration. Every
document is scored. Null text counts as empty, a null key reads as empty text, labels
that contradict one another count by their largest. Where the labels do not hold both
kinds, their share of toxic rows (0 without labels) is the score of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.llm.components import stored
from staylens.session import configure

SAMPLE = 100_000
TREES, DEPTH, RATE, LEAST_ROWS = 20, 3, 0.3, 5
# The learnt lexicon: rows it is counted on, letters of a stem, entries at most, unlike toxic texts that hold an entry at
# least, toxic texts for each other text that holds it, and the chance (power of ten) of a stem that means nothing.
LEXICON_SAMPLE, STEMS, ENTRIES, UNLIKE, PURE, CHANCE = 20_000, (4, 5, 6), 20_000, 8, 9, 8
THRESHOLD = 0.3
FOLDS, HELD = 4, 2
NEAR, STRETCH = 5, 50

# Stems in English, German, French and Spanish. A stem stands for itself and its endings.
INSULTS = """
idiot moron loser clown scum trash stupid pathetic worthless disgusting dumb imbecile jerk freak creep coward liar ugly
filthy garbage vermin parasite hypocrite brainless fool disgrace nobody lowlife degenerate useless
dummkopf trottel depp versager abschaum widerlich erbärmlich wertlos dumm blöd feigling nichtsnutz schwachkopf
imbécile crétin débile abruti ordure stupide minable pathétique dégoûtant bouffon lâche incapable
idiota imbécil estúpid tont basura patétic asqueros inútil perdedor payas escoria cobarde
""".split()
PROFANITY = """
crap damn bastard bitch shit fuck asshole bullshit arse wanker piss
scheiße scheisse arschloch mist verdammt connard salaud merde putain mierda cabrón joder
""".split()
THREATS = """
kill hate hurt destroy punish strangle murder threaten revenge suffer
töte hasse vernichte verrecke tuer déteste crever matar odio muere
""".split()
SECOND_PERSON = """
you your yours yourself youre u ur du dich dir dein deine deinen euch euer tu toi ton vous votre vos tú ti usted ustedes vosotros
""".split()
ENDINGS = ("", "s", "es", "ed", "er", "ers", "ing", "ly", "e", "en", "em", "n", "o", "a", "os", "as")

# Digits and symbols that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) | (_BYTES >= 0x80)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_FIRST = (_BYTES & 0xC0) != 0x80  # first byte of a code point
_OPENS = _LETTER | _DIGIT | np.isin(_BYTES, [ord("@"), ord("$")])
_CLOSES = _LETTER | _DIGIT
_PLAIN = np.where(_LETTER, W.LOWER, 0).astype(np.uint8)
_UNDONE = _PLAIN.copy()
for _sign, _letter in LOOKALIKES.items():
    _UNDONE[ord(_sign)] = ord(_letter)

NAMES = (
    "insults profanity threats hits peak addressed second_person disguised mixed stretched spelled masked "
    "capitals shouted exclaims asks repeated_marks words learnt learnt_hits"
).split()
N_FEATURES = len(NAMES)


def _rewritten(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray, single: bool) -> np.ndarray:
    """A hash of each span with every byte replaced by ``table`` (0: left out), repeated bytes once where ``single``."""
    value = table[data]
    keep = value != 0
    if single:
        before = np.where(keep, np.arange(len(data)), -1)
        before = np.concatenate(([-1], np.maximum.accumulate(before)[:-1])) if len(data) else before
        first = np.zeros(len(data) + 1, np.int64)
        first[start] = start
        first = np.maximum.accumulate(first)[:-1]
        keep &= ~((before >= first) & (value == value[before]))
    place = np.concatenate(([0], np.cumsum(keep)))
    out = np.zeros(len(start), np.uint64)
    some = np.flatnonzero(place[end] > place[start])
    out[some] = W.hashes(value[keep], place[start[some]], place[end[some]])
    return out


def _core(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without marks around them."""
    at = np.arange(len(data) + 1)
    opens = np.minimum.accumulate(np.where(np.append(_OPENS[data], False), at, len(data))[::-1])[::-1]
    closes = np.maximum.accumulate(np.where(np.concatenate(([False], _CLOSES[data])), at, 0))
    first, last = opens[start], closes[end]
    whole = (first < end) & (last > first)
    return np.where(whole, first, start), np.where(whole, last, start)


def _lexicon(stems: list[str], table: np.ndarray, single: bool) -> np.ndarray:
    data, off = W.raw(pa.array(sorted({s + e for s in stems for e in ENDINGS})))
    return np.unique(_rewritten(data, off[:-1], off[1:], table, single))


_LISTS = {name: (_lexicon(stems, _PLAIN, False), _lexicon(stems, _UNDONE, True)) for name, stems in (("insults", INSULTS), ("profanity", PROFANITY), ("threats", THREATS))}
_YOU = np.unique(W.hashes(*(lambda data, off: (data, off[:-1], off[1:]))(*W.raw(pa.array(SECOND_PERSON)))))


def _around(flags: np.ndarray, text: np.ndarray, reach: int) -> np.ndarray:
    """Whether a flagged word of the same text stands at most ``reach`` words away."""
    out = flags.copy()
    for k in range(1, reach + 1):
        out[k:] |= flags[:-k] & (text[k:] == text[:-k])
        out[:-k] |= flags[k:] & (text[k:] == text[:-k])
    return out


def _stems(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of STEMS: the words that begin with so many letters, and the hash of these."""
    lower = W.LOWER[data]
    points = np.append(np.flatnonzero(_FIRST[data]), len(data))
    before = np.concatenate(([0], np.cumsum(_FIRST[data])))
    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    for size in STEMS:
        word = np.flatnonzero(before[last] - before[first] >= size)
        stop = points[before[first[word]] + size]
        plain = letters[stop] - letters[first[word]] == stop - first[word]
        word, stop = word[plain], stop[plain]
        yield word, W.hashes(lower, first[word], stop, 1)


def _held(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``entries``."""
    if not len(entries):
        return np.zeros(len(values), bool)
    return entries[np.minimum(np.searchsorted(entries, values), len(entries) - 1)] == values


def text_features(data: np.ndarray, off: np.ndarray, learnt: np.ndarray = np.zeros(0, np.uint64)) -> np.ndarray:
    """One row of N_FEATURES numbers for each text of the buffer; ``learnt`` holds the sorted entries of the learnt lexicon."""
    n = len(off) - 1
    if not len(data):
        return np.zeros((n, N_FEATURES))
    start, end, text = W.spans(data, off)
    n_words = np.bincount(text, minlength=n)
    some = np.maximum(n_words, 1)
    first, last = _core(data, start, end)
    plain = _rewritten(data, first, last, _PLAIN, False)
    undone = _rewritten(data, first, last, _UNDONE, True)
    counts = {c: np.concatenate(([0], np.cumsum(f[data]))) for c, f in (("letters", _LETTER), ("upper", _UPPER), ("digits", _DIGIT), ("stars", _BYTES == ord("*")))}
    inside = {c: v[last] - v[first] for c, v in counts.items()}
    size = last - first
    odd = (inside["letters"] > 0) & (inside["letters"] < size)
    same = np.zeros(len(data) + 1, bool)
    same[2:-1] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]] if len(data) > 2 else False
    thrice = np.concatenate(([0], np.cumsum(same[:-1])))
    stretched = thrice[last] - thrice[np.minimum(first + 2, last)] > 0

    hit, disguised = np.zeros(len(start), bool), np.zeros(len(start), bool)
    by_list = {}
    for name, (exact, loose) in _LISTS.items():
        seen = np.isin(plain, exact) & (inside["letters"] == size) & (size > 0)
        hidden = ~seen & (odd | stretched) & np.isin(undone, loose)
        by_list[name] = seen | hidden
        hit |= by_list[name]
        disguised |= hidden
    letter = (size == 1) & (inside["letters"] == 1)
    runs, spelled = _spelled(data, first, last, text, letter)
    hit[runs] = True
    by_list["insults"][runs] = True
    disguised[runs] = True

    known = _held(plain, learnt) & (size > 0)
    if len(learnt):
        for word, value in _stems(data, first, last):
            known[word] |= _held(value, learnt)
    hit |= known

    you = np.isin(plain, _YOU) & (size > 0)
    near = hit & _around(you, text, NEAR)
    total = np.concatenate(([0], np.cumsum(hit)))
    begin = np.concatenate(([0], np.cumsum(n_words)))[:-1]
    stretch = total[1:] - total[np.maximum(np.arange(len(start)) + 1 - STRETCH, begin[text])]
    peak = np.zeros(n)
    np.maximum.at(peak, text, stretch)

    def rate(flags):
        return np.minimum(100 * np.bincount(text[flags], minlength=n) / some, 100)

    marks = np.isin(_BYTES, [ord("!"), ord("?")])[data]
    pairs = np.zeros(len(data), bool)
    pairs[1:] = marks[1:] & marks[:-1]
    letters = np.maximum(W.per_text(_LETTER[data], off), 1)
    columns = [
        rate(by_list["insults"]),
        rate(by_list["profanity"]),
        rate(by_list["threats"]),
        np.log1p(np.bincount(text[hit], minlength=n)),
        peak,
        rate(near),
        rate(you),
        rate(disguised),
        rate((inside["letters"] > 0) & (inside["digits"] > 0)),
        rate(stretched),
        rate(spelled),
        rate((inside["stars"] > 1) & (inside["letters"] > 0)),
        W.per_text(_UPPER[data], off) / letters,
        rate((inside["upper"] == size) & (size > 2)),
        W.per_text(data == ord("!"), off) / some,
        W.per_text(data == ord("?"), off) / some,
        W.per_text(pairs, off) / some,
        np.log1p(n_words),
        rate(known),
        np.log1p(np.bincount(text[known], minlength=n)),
    ]
    return np.stack(columns, axis=1)


def _spelled(data, first, last, text, letter) -> tuple[np.ndarray, np.ndarray]:
    """First words of runs of single letters that spell a word of a lexicon, and the words of all runs of four or more."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], letter.astype(np.int8), [0]))) != 0)
    begin, stop = edge[::2], edge[1::2]
    in_run = np.zeros(len(letter), bool)
    hits = []
    for a, b in zip(begin, stop):
        if b - a < 4 or text[a] != text[b - 1]:
            continue
        in_run[a:b] = True
        key = _rewritten(data[first[a] : last[b - 1]], np.array([0]), np.array([last[b - 1] - first[a]]), _UNDONE, True)
        if any(np.isin(key, loose)[0] for _, loose in _LISTS.values()):
            hits.append(a)
    return np.array(hits, np.int64), in_run


def _entry_counts(data: np.ndarray, off: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each word and stem of the texts: its hash, the toxic and other texts that hold it, and a bit for each kind of toxic one.

    A text's bit follows from its smallest hash of five words, which near copies mostly share.
    """
    start, end, text = W.spans(data, off)
    first, last = _core(data, start, end)
    plain = _rewritten(data, first, last, _PLAIN, False)
    least = np.zeros(len(off) - 1, np.uint64)
    value, at = W.windows(plain, text, 5)
    np.maximum.at(least, text[at], value)
    bit = np.uint64(1) << (W.mix(least) % np.uint64(64))
    found = [(plain[last > first], text[last > first]), *((value, text[word]) for word, value in _stems(data, first, last))]
    value, text = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((text, value))
    value, text = value[order], text[order]
    once = np.ones(len(value), bool)
    once[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[once], text[once]
    begin = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
    if not len(begin):
        return (np.zeros(0, np.int64),) * 4
    seen = np.bitwise_or.reduceat(np.where(toxic[text], bit[text], np.uint64(0)), begin)
    ill = np.add.reduceat(toxic[text].astype(np.int64), begin)
    return value[begin].view(np.int64), ill, np.diff(np.append(begin, len(value))) - ill, seen.view(np.int64)


def learnt_lexicon(docs: DataFrame, known: DataFrame, sample: int = LEXICON_SAMPLE) -> np.ndarray:
    """Hashes of words and stems that mark toxic texts; ``known`` has the doc_id and toxic of learning rows.

    An entry stands in UNLIKE unlike toxic texts or more, in PURE times as many toxic texts as others, and in so many
    that chance would not choose them.
    """
    known = known.where(W.by_share(F.col("doc_id"), W.sample_share(known.count(), sample), 12))
    texts = docs.where("text IS NOT NULL").join(F.broadcast(known), "doc_id").groupBy(F.xxhash64("text").alias("text_key"))
    texts = texts.agg(F.min("text").alias("text"), (F.avg((F.col("toxic") > 0).cast("double")) >= 0.5).alias("ill")).select("text", "ill")

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            ill = batch.column("ill").to_numpy(zero_copy_only=False).astype(bool)
            counted = _entry_counts(*W.raw(batch.column("text")), ill)
            kinds = pa.array([int(ill.sum())]), pa.array([int((~ill).sum())])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), *kinds, pa.array([0])], names=["entry", "ill", "well", "seen"])
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in counted], names=["entry", "ill", "well", "seen"])

    counts = texts.mapInArrow(count, "entry bigint, ill bigint, well bigint, seen bigint").groupBy("entry")
    counts = counts.agg(F.sum("ill").alias("ill"), F.sum("well").alias("well"), F.bit_count(F.bit_or("seen")).alias("unlike"))
    # The row without an entry holds all texts; it sorts first.
    chosen = counts.where(f"entry IS NULL OR (unlike >= {UNLIKE} AND ill >= {PURE} * well)")
    rows = chosen.orderBy(F.col("entry").isNotNull(), (F.col("ill") - PURE * F.col("well")).desc(), "entry").limit(ENTRIES + 1).collect()
    if not rows or not rows[0]["ill"] or not rows[0]["well"]:
        return np.zeros(0, np.uint64)
    ill, well = rows[0]["ill"], rows[0]["well"]
    least = CHANCE / np.log10((ill + well) / ill)
    return np.sort(np.array([r["entry"] for r in rows[1:] if r["ill"] >= least], np.int64).view(np.uint64))


def featured(docs: DataFrame, learnt: np.ndarray = np.zeros(0, np.uint64)) -> DataFrame:
    """doc_id, a hash of the text, and features of every row of ``docs``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            values = text_features(*W.raw(batch.column("text")), learnt).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, N_FEATURES, dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), lists], names=["doc_id", "text_key", "features"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(read, "doc_id bigint, text_key bigint, features array<float>")


def learning_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the learning folds; labels that contradict one another count by their largest."""
    fold = W.remainder(F.col("doc_id"), FOLDS) != HELD
    return labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def learn(spark: SparkSession, rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Callable[[DataFrame], DataFrame]:
    """Fit on the learning folds of featured ``rows``; ``labels`` has doc_id, toxic. The result adds a score to featured rows."""
    known = learning_labels(labels)
    known = known.where(W.by_share(F.col("doc_id"), W.sample_share(known.count(), sample), 11))
    seen = rows.join(F.broadcast(known), "doc_id").groupBy("text_key", "features").agg((F.avg((F.col("toxic") > 0).cast("double")) >= 0.5).cast("double").alias("label"))
    seen = stored(spark, seen.select(array_to_vector("features").alias("x"), "label", (F.pmod("text_key", F.lit(3)) < 2).alias("grow")), "toxicity-learn")
    kinds = {(r["grow"], r["label"]): r["n"] for r in seen.groupBy("grow", "label").agg(F.count("*").alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 4:
        share = sum(n for (_, label), n in kinds.items() if label) / total if total else 0.0
        return lambda some: some.withColumn("score", F.lit(share))
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, minInstancesPerNode=LEAST_ROWS, seed=7).fit(seen.where("grow"))

    def margin(some: DataFrame) -> DataFrame:
        return trees.transform(some).withColumn("margin", vector_to_array("rawPrediction")[1])

    curve = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margin(seen.where("NOT grow")).select("margin", "label"))

    def score(some: DataFrame) -> DataFrame:
        out = curve.transform(margin(some.withColumn("x", array_to_vector("features"))))
        return out.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))

    return score


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs, labels = W.documents(spark, sf_dir), W.documents(spark, sf_dir, "labels")
    rows = stored(spark, featured(docs, learnt_lexicon(docs, learning_labels(labels))), "toxicity-features")
    scored = learn(spark, rows, labels)(rows)
    held = W.remainder(F.col("doc_id"), FOLDS) == HELD
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

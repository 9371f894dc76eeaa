r"""Importance resampling of documents towards a target set, over hashed word n-grams.

Every run of 1 to 3 words is a feature; its bucket is crc32 modulo ``BUCKETS``. The
gain of a bucket compares the smoothed share of the target with that of the corpus,
a text's weight is the sum of its features' gains, and Gumbel noise fixed by the key
turns the weights into a draw without replacement.

Head and tail vocabulary: one job counts all words; up to ``HEAD`` of the most frequent
go out with the exact crc32 state of the word and of the word after a space, the
``PAIRS`` most frequent of them with the state and bucket of every pair. A feature of
head words is a look-up; a word of the tail takes its crc32 directly from its bytes. Both give the exact
bucket, so the head changes time only, never a number. Totals are summed per task
before they are shuffled, and the ranking is a range sort with one count per range.

A null text has no features and weight 0. A null key reads as empty text in the
noise; equal scores go to the smaller key (null last), and rows equal in both are
interchangeable. Empty tables give no rows, an empty target only smooths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import crc
from staylens.llm import words as W
from staylens.llm.components import stored
from staylens.session import configure, scratch_path

BUCKETS = 10_000
HEAD, PAIRS = 16_384, 512
HEAD_BYTES = 64
MIN_WORDS, PER_CENT, SEED = 20, 5, 42

# Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _words(texts: pa.Array):
    data, off = W.raw(texts)
    data = W.LOWER[data]
    return (data, *W.spans(data, off, _WORD))


class Head:
    """The frequent words with their states, and the states and buckets of pairs of the most frequent."""

    def __init__(self, words: list[str]):
        self.words = pa.array(words, pa.large_string())
        data, off = W.raw(self.words)
        self.size = np.diff(off)
        self.alone = crc.of_spans(data, off[:-1], off[1:])
        self.after = spaced(self.alone, self.size)
        n = min(len(words), PAIRS)
        first, second = np.divmod(np.arange(n * n), max(n, 1))
        self.pair = crc.then(self.alone[first], self.after[second], self.size[second] + 1)
        self.pair_bucket = (self.pair % np.uint32(BUCKETS)).astype(np.int32)
        self.n = n


def spaced(state: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of a space and a word, from that of the word."""
    space = crc.of_spans(np.array([32], np.uint8), np.array([0]), np.array([1]))
    return crc.then(np.repeat(space, len(state)), state, size)


def buckets(head: Head, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature, and the number of words of each text."""
    data, start, end, text = _words(texts)
    size = end - start
    found = pc.index_in(crc.strings(data, start, end), head.words)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    item = found.fill_null(0).to_numpy(zero_copy_only=False)
    alone, after = np.empty(len(start), np.uint32), np.empty(len(start), np.uint32)
    alone[known], after[known] = head.alone[item[known]], head.after[item[known]]
    tail = np.flatnonzero(~known)
    alone[tail] = crc.of_spans(data, start[tail], end[tail])
    after[tail] = spaced(alone[tail], size[tail])

    two = np.flatnonzero(text[:-1] == text[1:])
    frequent = known & (item < head.n)
    seen = frequent[two] & frequent[two + 1]
    place = item[two[seen]].astype(np.int64) * head.n + item[two[seen] + 1]
    pair, pair_bucket = np.empty(len(start), np.uint32), np.empty(len(two), np.int32)
    pair[two[seen]], pair_bucket[seen] = head.pair[place], head.pair_bucket[place]
    rest = two[~seen]
    pair[rest] = crc.then(alone[rest], after[rest + 1], size[rest + 1] + 1)
    pair_bucket[~seen] = pair[rest] % np.uint32(BUCKETS)

    three = two[:-1][np.diff(two) == 1]  # words i, i + 1 and i + 2 of one text
    triple = crc.then(pair[three], after[three + 2], size[three + 2] + 1)
    modulo = np.uint32(BUCKETS)
    all_buckets = np.concatenate(((alone % modulo).astype(np.int32), pair_bucket, (triple % modulo).astype(np.int32)))
    return all_buckets, np.concatenate((text, text[two], text[three])), np.bincount(text, minlength=len(texts))


def frequent_words(spark: SparkSession, docs: DataFrame, n: int = HEAD) -> list[str]:
    """At most ``n`` of the most frequent words of at most HEAD_BYTES bytes, counted per task before they are shuffled.

    Counts fall into steps of a sixteenth of a doubling; all steps are taken whose words together are at most ``n``.
    """

    def count(batches) -> Iterator[pa.RecordBatch]:
        yield from W.tallies(_counted(batches))

    counts = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(spark, counts.withColumn("step", F.floor(16 * F.log2("n"))), "importance-words")
    steps = {r["step"]: r["n"] for r in counts.groupBy("step").agg(F.count("*").alias("n")).collect()}
    least, taken = max(steps, default=0) + 1, 0
    for step in sorted(steps, reverse=True):
        taken += steps[step]
        if taken > n:
            break
        least = step
    words = counts.where(F.col("step") >= least).collect()
    return [r["word"] for r in sorted(words, key=lambda r: (-r["n"], r["word"]))]


def _counted(batches) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in W.chunks(batches):
        data, start, end, _ = _words(batch.column("text"))
        short = end - start <= HEAD_BYTES
        found = pc.value_counts(crc.strings(data, start[short], end[short]))
        yield found.field("values"), found.field("counts")


def totals(rows: DataFrame, head: Head) -> DataFrame:
    """(bucket, n) over all texts of ``rows``; one addition per task and bucket is shuffled."""

    def add(batches) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in W.chunks(batches):
            sums += np.bincount(buckets(head, batch.column("text"))[0], minlength=BUCKETS)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    return rows.select("text").mapInArrow(add, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(spark: SparkSession, corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, from the totals of both sides (BUCKETS rows)."""
    both = (
        spark.range(BUCKETS)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .fillna(0)
        .toPandas()
        .sort_values("bucket")
    )
    s, t = both["s"].to_numpy(float), both["t"].to_numpy(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))))


def weigh(docs: DataFrame, head: Head, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of ``docs``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            bucket, text, n_words = buckets(head, batch.column("text"))
            n = batch.num_rows
            weight = np.bincount(text, gains[bucket], minlength=n).astype(np.int64)
            columns = [batch.column("doc_id"), pa.array(n_words), pa.array(np.bincount(text, minlength=n)), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(key, seed: int = SEED):
    """Gumbel noise in thousandths, fixed by the key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(spark: SparkSession, scored: DataFrame) -> DataFrame:
    """``scored`` (doc_id, n_words, score, ...) with the place among the drawn ones, null for the others.

    All rows are sorted by ranges, those that may be drawn first. Each range is one
    task, numbered in itself; adding the sizes of earlier ranges gives the place.
    """
    first, last = scratch_path(spark, "importance-scored"), scratch_path(spark, "importance-sorted")
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(first)
    rows = spark.read.parquet(first)
    may = F.col("n_words") >= MIN_WORDS
    order = [F.when(may, 0).otherwise(1), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed.write.parquet(last)
    placed = spark.read.parquet(last)
    part = F.shiftright("at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    drawn = rows.where(may).count() * PER_CENT // 100
    offsets = F.broadcast(spark.createDataFrame(before, "part bigint, before bigint"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("part", part).join(offsets, "part").withColumn("rank", F.when(may & (rank <= drawn), rank))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs, target = W.documents(spark, sf_dir), W.documents(spark, sf_dir, "benchmark")
    head = Head(frequent_words(spark, docs))
    gains = bucket_gains(spark, totals(docs, head), totals(target, head))
    scored = weigh(docs, head, gains).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    return ranked(spark, scored).select("doc_id", "n_features", "weight", "score", "rank")


# crc32 is folded byte by byte, over a table made by the rule of its polynomial.
SQL = r"""
WITH steps AS (
  SELECT list(v ORDER BY b) AS step FROM (
    SELECT b, list_reduce([b] || [0 FOR x IN range(8)], lambda v, x: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM range(256) AS t(b))),
d AS (
  SELECT true AS corpus, doc_id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT false, NULL, row_number() OVER (), text FROM benchmark),
w AS (
  SELECT corpus, doc_id, r, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM d),
f AS (SELECT corpus, r, array_to_string(list_slice(w, i, i + n - 1), ' ') AS feature FROM w, range(1, 4) AS g(n), unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
counted AS (SELECT corpus, r, feature, count(*) AS n FROM f GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce([4294967295] || [CAST('0x' || substr(hex(encode(feature)), 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, octet_length(encode(feature)) + 1)],
    lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), steps),
c AS (SELECT corpus, r, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
total AS (SELECT bucket, coalesce(sum(n) FILTER (corpus), 0) AS s, coalesce(sum(n) FILTER (NOT corpus), 0) AS t FROM c GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS gain FROM total),
weighed AS (
  SELECT w.doc_id, len(w.w) AS n_words, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS n_features, CAST(coalesce(sum(c.n * gain), 0) AS BIGINT) AS weight
  FROM w LEFT JOIN c ON c.corpus AND c.r = w.r LEFT JOIN gain USING (bucket) WHERE w.corpus GROUP BY w.r, w.doc_id, len(w.w)),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM weighed),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM placed
"""

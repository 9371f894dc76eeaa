r"""Spelling variants of corpus words, found through a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Words one edit apart reduce to symbol
strings that are equal or one edit apart, so the full one-edit neighbourhood of every
distinct reduced word (itself, all deletions, replacements and insertions of symbols)
is joined to the reduced vocabulary, and the words behind each meeting are compared on
their own letters inside the join. Neighbourhoods are symmetric: of the two
directions of a meeting one travels.

Occurrences are counted per task before they are shuffled. A reduced word meets at
most as many others as its neighbourhood holds; a word has at most some 200 near words
a letter, which bounds the keys of the joins on forms. The forms of forms are followed
by doubling, each round written to the shared folder.

A null text has no words, a null key reads as empty text, an empty table gives no
rows. Ties between near words go to the smaller one in code-point order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import crc
from staylens.llm import words as W
from staylens.llm.components import stored
from staylens.session import configure

SYMBOLS = 6
MIN_LENGTH, MIN_COUNT, RATIO, MODULUS = 6, 5, 5, 199

LETTERS = "".join(chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)])
_FIRST = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_ASCII = ((np.arange(256) | 32) >= 97) & ((np.arange(256) | 32) <= 122)
_RUN = np.array([False, True])


def symbols(n: int = SYMBOLS) -> str:
    """The symbol of each of LETTERS."""
    value = W.mix(np.array([ord(c) for c in LETTERS], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return "".join(chr(97 + int(v % np.uint64(n))) for v in value)


def _runs(texts: pa.Array):
    """Runs [A-Za-zÀ-ÿ]+ of lower-cased texts: a letter, or the lead byte C3 with the byte after it."""
    data, off = W.raw(texts)
    data = W.LOWER[data]
    inside = _ASCII[data] | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    return (data, *W.spans(inside.astype(np.uint8), off, _RUN))


def _without(word: bytes, h: int) -> str:
    text = word.decode()
    k = h % len(text)
    return text[:k] + text[k + 1 :]


def _counted(batches, min_length: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in W.chunks(batches):
        data, start, end, text = _runs(batch.column("text"))
        first = np.concatenate(([0], np.cumsum(_FIRST[data], dtype=np.int64)))
        long = first[end] - first[start] >= min_length
        start, end, text = start[long], end[long], text[long]
        if not len(start):
            continue
        words = crc.strings(data, start, end).dictionary_encode()
        code = words.indices.to_numpy().astype(np.int64)
        kinds = words.dictionary
        # All occurrences of one word in one document fare alike.
        pair, n = np.unique(text * len(kinds) + code, return_counts=True)
        text, code = np.divmod(pair, len(kinds))
        body, off = W.raw(kinds)
        size = np.diff(off)
        keys = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in batch.column("doc_id").to_pylist()], np.uint32)
        h = crc.then(keys[text], crc.of_spans(body, off[:-1], off[1:])[code], size[code])
        cut = h % np.uint32(MODULUS) == 0
        yield kinds, pa.array(np.bincount(code[~cut], n[~cut], minlength=len(kinds)).astype(np.int64))
        cuts = [_without(body[off[c] : off[c + 1]].tobytes(), int(x)) for c, x in zip(code[cut], h[cut])]
        some = np.array([len(w) >= min_length for w in cuts], bool)
        yield pa.array(cuts, pa.large_string()).filter(pa.array(some)), pa.array(n[cut][some].astype(np.int64))


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs``, a letter lost where the hash of key and run says so."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        yield from W.tallies(_counted(batches, min_length))

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def neighbourhood(word, n_symbols: int = SYMBOLS):
    """A reduced word and all symbol strings one edit away, as an array column; may hold repeats."""
    size = F.length(word)
    places, gaps = F.sequence(F.lit(1), size), F.sequence(F.lit(1), size + 1)

    def put(sign: str, after: int):
        """The word with ``sign`` before the i-th symbol, of which ``after`` are left out."""
        return lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.lit(sign), F.substring(word, i + after, size))

    lists = [F.array(word), F.transform(places, put("", 1))]
    for sign in (chr(97 + k) for k in range(n_symbols)):
        lists += [F.transform(places, put(sign, 1)), F.transform(gaps, put(sign, 0))]
    return F.concat(*lists)


def near_pairs(spark: SparkSession, counted: DataFrame, n_symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): both directions of every two words exactly one edit apart."""
    reduced = F.translate(F.col("word"), LETTERS, symbols(n_symbols))
    known = stored(spark, counted.withColumn("reduced", reduced).withColumn("key", F.xxhash64("reduced")), "variants-known")
    kinds = known.groupBy("key", "reduced").agg(F.lit(1).alias("one"))
    meets = kinds.select("key", F.explode(F.array_distinct(F.transform(neighbourhood(F.col("reduced"), n_symbols), lambda r: F.xxhash64(r)))).alias("meets"))
    meets = meets.where("meets >= key")
    there = known.select(F.col("key").alias("meets")).distinct()
    meets = stored(spark, meets.join(there, "meets", "left_semi"), "variants-meets")
    left = known.select("key", "word", "n")
    right = known.select(F.col("key").alias("meets"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # A reduced word that meets itself brings its words up in both orders: one is enough.
    once = (F.col("key") != F.col("meets")) | (F.col("word") < F.col("other"))
    near = left.join(meets, "key").join(right, "meets").where((F.levenshtein("word", "other", 1) == 1) & once)
    found = stored(spark, near.select("word", "n", "other", "other_n").distinct(), "variants-pairs")
    return found.unionByName(found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(word, root): the end of the path of ``links`` (word, form) from every word that has one; paths double each round."""
    path = stored(spark, links.select("word", F.col("form").alias("root")), "variants-path")
    while True:
        ahead = path.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = path.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        path = stored(spark, step, "variants-path")
        if path.where("moved").isEmpty():
            return path.select("word", "root")


def variants(spark: SparkSession, docs: DataFrame, n_symbols: int = SYMBOLS, ratio: int = RATIO) -> DataFrame:
    """Every word of the vocabulary with its form, root and counts."""
    counted = stored(spark, vocabulary(docs), "variants-vocabulary")
    best = near_pairs(spark, counted, n_symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    top = -F.col("best.minus")
    rows = counted.join(best, "word", "left").select(
        "word",
        F.when(top >= ratio * F.col("n"), F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(top >= ratio * F.col("n"), top).alias("form_n"),
    )
    rows = stored(spark, rows, "variants-forms")
    ends = roots(spark, rows.where(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return variants(spark, W.documents(spark, sf_dir))


# Words one edit apart agree once a letter is deleted on one side, or one is masked on both.
SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY b) AS step FROM (
    SELECT b, list_reduce([b] || [0 FOR x IN range(8)], lambda v, x: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v
    FROM range(256) AS t(b))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS w
  FROM documents),
per AS (SELECT k, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (
  SELECT k, w, n, xor(list_reduce([4294967295] || [CAST('0x' || substr(hex(encode(k || ':' || w)), 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, octet_length(encode(k || ':' || w)) + 1)],
    lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM per, steps),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS part FROM vocabulary, unnest(generate_series(1, length(word))) AS t(i)),
masked AS (SELECT word, n, left(word, i - 1) || '_' || substr(word, i + 1) AS part FROM vocabulary, unnest(generate_series(1, length(word))) AS t(i)),
near AS (
  SELECT cut.word, cut.n, v.word AS other, v.n AS other_n FROM cut JOIN vocabulary AS v ON v.word = part
  UNION ALL SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN vocabulary AS v ON v.word = part
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM masked AS a JOIN masked AS b USING (part) WHERE a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
chosen AS (SELECT word, n_near, top, min(other) AS other FROM near JOIN best USING (word) WHERE other_n = top GROUP BY ALL),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * n THEN other END AS form, CASE WHEN top >= 5 * n THEN top END AS form_n
  FROM vocabulary LEFT JOIN chosen USING (word)),
path AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, p.root FROM path AS p JOIN forms AS f ON f.form = p.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN path USING (word)
"""

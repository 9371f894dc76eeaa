r"""Benchmark decontamination by winnowing, in DataFrame operations only.

A text is lower-cased in A-Z and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
From every ``WINDOW`` (10) consecutive words the smallest of its ``GRAM``-word hashes
is kept as fingerprint; equal windows keep equal fingerprints, so a join on
fingerprints meets every shared window. Each hit is extended on both sides to the
windows around it and these are compared word by word. An item of fewer words is
one window with its own fingerprint.

Null text has no words. Rows are told apart by key and text: rows equal in both
get the same counts, a null key is a key. Without items nothing is hit. The item
fingerprints are written to the shared folder first, so that their measured size
decides whether Spark broadcasts them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.words import documents
from staylens.session import configure, scratch_path

WINDOW, GRAM = 10, 5
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_list(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, BREAKS, -1), "")


def _over(n: Column, use) -> Column:
    """``use(i)`` for i = 1 to n, as an array; empty where n < 1."""
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), use))


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive words."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _over(F.size(h) - (size - 1), lambda i: F.xxhash64(F.slice(h, i, size))))


def winnowed(words: Column) -> Column:
    """The distinct fingerprints of all windows."""
    span = WINDOW - GRAM + 1
    kept = let(gram_hashes(words, GRAM), lambda g: _over(F.size(g) - (span - 1), lambda i: F.array_min(F.slice(g, i, span))))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<bigint>"))


def fingerprints(words: Column, lengths: list[int]) -> Column:
    """Winnowed fingerprints, and those of the short item lengths in use."""
    more = [F.coalesce(gram_hashes(words, n), F.array().cast("array<bigint>")) for n in lengths]
    return F.array_distinct(F.concat(winnowed(words), *more)) if more else winnowed(words)


def item_prints(items: DataFrame) -> DataFrame:
    """(print, size, item_id, before, around) of every fingerprint of every item.

    ``around`` holds the item's words near the print, ``before`` how many of them precede it.
    """
    rows = items.select("item_id", word_list(F.col("text")).alias("words")).where(F.size("words") > 0)
    span = WINDOW - GRAM + 1
    place = let(
        gram_hashes(F.col("words"), GRAM),
        lambda g: _over(
            F.size(g) - (span - 1),
            lambda i: F.array_min(F.transform(F.sequence(i, i + (span - 1)), lambda j: F.struct(F.element_at(g, j).alias("print"), j.alias("at")))),
        ),
    )
    long = rows.where(F.size("words") >= WINDOW).select("item_id", "words", F.explode(F.array_distinct(place)).alias("p"))
    first = F.greatest(F.col("p.at") - span + 1, F.lit(1))
    long = long.select(
        F.col("p.print").alias("print"),
        F.lit(GRAM).alias("size"),
        "item_id",
        (F.col("p.at") - first).alias("before"),
        F.slice("words", first, F.col("p.at") - first + WINDOW).alias("around"),
    )
    short = rows.where(F.size("words") < WINDOW).select(
        F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))).alias("print"), F.size("words").alias("size"), "item_id", F.lit(0).alias("before"), F.col("words").alias("around")
    )
    return long.unionByName(short)


def shared_windows(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, start, size): every occurrence of an item's window in a text, start from 1."""
    path = scratch_path(spark, "item-prints")
    item_prints(items).write.parquet(path)
    prints = spark.read.parquet(path)
    lengths = sorted(r["size"] for r in prints.where("around IS NOT NULL AND size(around) < %d" % WINDOW).select("size").distinct().collect())  # at most nine
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    met = (
        keyed.select("doc_id", "text_key", F.explode(fingerprints(word_list(F.col("text")), lengths)).alias("print"))
        .join(prints.select("print").distinct(), "print")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("print").alias("met"))
        .withColumnsRenamed({"doc_id": "met_id", "text_key": "met_key"})
    )
    near = keyed.join(met, (F.col("text_key") == F.col("met_key")) & F.col("doc_id").eqNullSafe(F.col("met_id")))
    near = near.select("doc_id", "text_key", word_list(F.col("text")).alias("words"), "met")
    hits = None
    span = WINDOW - GRAM + 1
    for size in sorted({GRAM, *lengths}):
        found = let(
            gram_hashes(F.col("words"), size),
            lambda g: F.filter(_over(F.size(g), lambda i: F.struct(i.alias("at"), F.element_at(g, i).alias("print"))), lambda s: F.array_contains("met", s["print"])),
        )
        part = near.select("doc_id", "text_key", "words", F.explode(found).alias("p"))
        first = F.greatest(F.col("p.at") - span + 1, F.lit(1)) if size == GRAM else F.col("p.at")
        last = F.col("p.at") + WINDOW - first
        part = part.select("doc_id", "text_key", "p.print", F.lit(size).alias("size"), F.col("p.at").alias("at"), (F.col("p.at") - first).alias("ahead"), F.slice("words", first, last).alias("here"))
        hits = part if hits is None else hits.unionByName(part)
    pairs = hits.join(prints, ["print", "size"])
    # Long items: each of the up to six windows that hold the print, if it lies inside both texts.
    whole = F.size("around") >= WINDOW

    def equal(back: Column) -> Column:
        mine, theirs = F.slice("here", F.col("ahead") - back + 1, WINDOW), F.slice("around", F.col("before") - back + 1, WINDOW)
        return (F.size(mine) == WINDOW) & (mine == theirs)

    extended = F.filter(F.sequence(F.lit(0), F.least("ahead", "before", F.lit(span - 1))), equal)
    short = F.when(F.slice("here", F.col("ahead") + 1, F.col("size")) == F.col("around"), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return pairs.select(
        "doc_id",
        "text_key",
        "item_id",
        F.explode(F.when(whole, extended).otherwise(short)).alias("back"),
        "at",
        F.when(whole, WINDOW).otherwise(F.col("size")).alias("size"),
    ).select("doc_id", "text_key", "item_id", (F.col("at") - F.col("back")).alias("start"), "size")


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_key, hit (word positions from 1), items for every contaminated text."""
    found = shared_windows(spark, docs, items)
    return (
        found.groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
        .select(
            "doc_id",
            "text_key",
            F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))).alias("hit"),
            "items",
        )
    )


def _with_hits(spark: SparkSession, docs: DataFrame, items: DataFrame, how: str, kept: Column) -> DataFrame:
    """Every row of ``docs`` as (row_id, row_key, kept), joined to its hits."""
    hits = contamination(spark, docs, items)
    left = docs.select(F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_key"), kept.alias("kept"))
    return left.join(hits, (F.col("row_key") == F.col("text_key")) & F.col("row_id").eqNullSafe(F.col("doc_id")), how)


def uncontaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with any item, with all their columns."""
    return _with_hits(spark, docs, items, "left_anti", F.struct(*docs.columns)).select("kept.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    n_words = F.size(word_list(F.col("text"))).cast("long")
    rows = _with_hits(spark, docs, documents(spark, sf_dir, "benchmark"), "left", n_words)
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("row_id").alias("doc_id"),
        F.col("kept").alias("n_words"),
        F.when(F.col("hit").isNull(), 0).otherwise(F.size("hit")).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )


# Windows of the items, found in the words of every text by position.
SQL = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents),
b AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
m AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM m), unnest(generate_series(i, i + n - 1)) AS t(p) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

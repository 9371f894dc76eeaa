r"""Substring de-duplication by super-k-mer partitioning.

A window is ``WINDOW`` (13) consecutive words ``[^\x20\x09-\x0D]+`` of one text.
Its minimiser is the smallest hash of its ``MINIMISER``-word runs; consecutive
windows with the same minimiser travel as one packed string, words joined by a
space, to the bucket that the minimiser names. There all windows are sorted and
the first document of each is found. A word is removed when a window over it also
starts in a document with a smaller key; windows are judged on the input.

Equal packed strings of a block of neighbouring documents travel once, with the
smallest and largest key that holds them, compressed with the others of the same
bucket: a passage in a third of all documents costs a bucket one string a block.
A minimiser that very many strings share (``hot_minimisers``) does not name a
bucket: its windows travel one by one, spread by their own hash. Answers return to
the block as (string, first documents) where a larger key holds the string.

Sorting compares 128-bit window hashes. Null text has no words. A null key counts
as larger than every other; rows with equal keys remove nothing from each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.session import configure

WINDOW, MINIMISER = 13, 3
BLOCK_DOCS = 2048
CHUNK = 4 << 20
BUCKET_BYTES = 6 << 20  # text a bucket stands for
HOT_SAMPLE_BLOCKS, HOT_SHARE, HOT_LIMIT = 16, 1 / 500, 500
NO_KEY = np.iinfo(np.int64).max
PACKED = "block bigint, bucket bigint, sizes binary, least binary, most binary, packed binary"
ANSWER = "block bigint, keys binary, counts binary, firsts binary"

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def blocked(docs: DataFrame) -> DataFrame:
    """doc_id, text and a block of neighbouring documents; rows without key spread by text."""
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(4096))
    return docs.select(F.coalesce(F.floor(F.col("doc_id") / BLOCK_DOCS), spread).alias("block"), "doc_id", "text")


class Text:
    """The words of some texts, joined by single spaces, with hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        start, end, self.text = W.spans(data, off)
        where, first = W.flat(start, end + 1)
        self.bytes = np.append(data, np.uint8(32))[where]
        self.at = np.append(first, len(where))
        self.bytes[self.at[1:] - 1] = 32
        self.hash = W.hashes(self.bytes, self.at[:-1], self.at[1:] - 1)


def run_keys(word: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words first..end of each run, the same wherever the run stands."""
    power = np.full(len(word) + 1, _PRIME)
    power[0] = 1
    power = np.cumprod(power)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word * power[:-1])))
    back = np.full(len(word) + 1, _INVERSE)
    back[0] = 1
    return W.mix((sums[end] - sums[first]) * np.cumprod(back)[first] + (end - first).astype(np.uint64))


def super_kmers(word: np.ndarray, text: np.ndarray, hot: np.ndarray):
    """First word, end, minimiser and key of every super-k-mer; a window of a hot minimiser is one of its own."""
    value, place = W.windows(word, text, MINIMISER)
    order = np.full(len(word), np.iinfo(np.uint64).max, np.uint64)
    order[place] = value
    start = np.flatnonzero(text[: len(word) - WINDOW + 1] == text[WINDOW - 1 :]) if len(word) >= WINDOW else np.zeros(0, np.int64)
    best, chosen = order[start], start.copy()
    for i in range(1, WINDOW - MINIMISER + 1):
        now = order[start + i]
        less = now < best
        best = np.where(less, now, best)
        chosen = np.where(less, start + i, chosen)
    is_hot = np.isin(best, hot) if len(hot) else np.zeros(len(best), bool)
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | is_hot[1:]
    first = start[new]
    last = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else first
    end = last + WINDOW
    key = run_keys(word, first, end)
    return first, end, np.where(is_hot[new], W.mix(key), best[new]), key


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(NO_KEY).to_numpy()


def pack(docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Packed strings by block and bucket."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in W.chunks(batches, limit=CHUNK):
            t = Text(*W.raw(batch.column("text")))
            first, end, minimiser, key = super_kmers(t.hash, t.text, hot)
            if not len(first):
                continue
            block = batch.column("block").to_numpy()[t.text[first]]
            doc = _keys(batch)[t.text[first]]
            bucket = (W.mix(minimiser + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((key, bucket, block))
            same = (key[order][1:] == key[order][:-1]) & (block[order][1:] == block[order][:-1])
            one = np.flatnonzero(np.concatenate(([True], ~same)))
            least, most = np.minimum.reduceat(doc[order], one), np.maximum.reduceat(doc[order], one)
            order = order[one]
            first, end, block, bucket = first[order], end[order], block[order], bucket[order]
            edge = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (bucket[1:] != bucket[:-1]), [True])))
            rows = []
            for a, b in zip(edge[:-1], edge[1:]):
                where, _ = W.flat(t.at[first[a:b]], t.at[end[a:b]])
                sizes = (end[a:b] - first[a:b]).astype(np.uint8)
                rows.append((int(block[a]), int(bucket[a]), *(squeeze(x.tobytes()) for x in (sizes, least[a:b], most[a:b], t.bytes[where]))))
            kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in PACKED.split(", ")])

    return docs.mapInArrow(read, PACKED)


def answer(packed: DataFrame) -> DataFrame:
    """Sort the windows of each bucket; first documents of the strings that a larger key holds, by block."""

    def read(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        whole = {c: [np.frombuffer(expand(x.as_py()), k) for x in table.column(c)] for c, k in (("sizes", np.uint8), ("least", np.int64), ("most", np.int64), ("packed", np.uint8))}
        block = np.repeat(table.column("block").to_numpy(), [len(x) for x in whole["sizes"]])
        sizes, least, most, data = (np.concatenate(whole[c]) for c in ("sizes", "least", "most", "packed"))
        del whole
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        word = W.hashes(data, starts, ends)
        run = np.repeat(np.arange(len(sizes)), sizes)
        value, place = W.windows(word, run, WINDOW)
        other, _ = W.windows(W.mix(word + _PRIME), run, WINDOW)
        owner = run[place]
        order = np.lexsort((other, value))
        new = np.ones(len(order), bool)
        new[1:] = (value[order][1:] != value[order][:-1]) | (other[order][1:] != other[order][:-1])
        firsts = np.empty(len(order), np.int64)
        firsts[order] = np.minimum.reduceat(least[owner[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
        asked = np.zeros(len(sizes), bool)
        asked[owner[firsts < most[owner]]] = True
        end = np.cumsum(sizes, dtype=np.int64)
        key = run_keys(word, end - sizes, end)
        rows = []
        squeeze = zstandard.ZstdCompressor(level=3).compress
        count = sizes.astype(np.int64) - WINDOW + 1
        begin = np.cumsum(count) - count
        picked = np.flatnonzero(asked)
        picked = picked[np.argsort(block[picked], kind="stable")]
        edge = np.flatnonzero(np.concatenate(([True], block[picked][1:] != block[picked][:-1], [True]))) if len(picked) else []
        for a, b in zip(edge[:-1], edge[1:]):
            part = picked[a:b]
            where, _ = W.flat(begin[part], begin[part] + count[part])
            rows.append((int(block[part[0]]), *(squeeze(x.tobytes()) for x in (key[part], count[part].astype(np.uint8), firsts[where]))))
        kinds = (pa.int64(), *[pa.binary()] * 3)
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table({c.split()[0]: pa.array(v, k) for c, v, k in zip(ANSWER.split(", "), columns, kinds)})

    return packed.groupBy("bucket").applyInArrow(read, ANSWER)


def cut(docs: DataFrame, answers: DataFrame, hot: np.ndarray, out: str) -> DataFrame:
    """Remove the covered words of each block's texts."""

    def read(texts: pa.Table, answers: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        parts = [np.concatenate([np.frombuffer(expand(x.as_py()), k) for x in answers.column(c)] or [np.zeros(0, k)]) for c, k in (("keys", np.uint64), ("counts", np.uint8), ("firsts", np.int64))]
        keys, counts, firsts = parts
        begin = np.cumsum(counts, dtype=np.int64) - counts
        by = np.argsort(keys, kind="stable")
        keys, begin = keys[by], begin[by]
        rows = []
        for batch in W.chunks(texts.to_batches(), limit=CHUNK):
            n = batch.num_rows
            t = Text(*W.raw(batch.column("text")))
            first, end, _, key = super_kmers(t.hash, t.text, hot)
            gone = np.zeros(len(t.hash), bool)
            if len(keys) and len(first):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                first, end, at = first[hit], end[hit], at[hit]
                size = end - first - WINDOW + 1
                window, _ = W.flat(first, first + size)
                told, _ = W.flat(begin[at], begin[at] + size)
                window = window[firsts[told] < _keys(batch)[t.text[window]]]
                for i in range(WINDOW):
                    gone[window + i] = True
            stay = np.flatnonzero(~gone)
            where, _ = W.flat(t.at[stay], t.at[stay + 1])
            ends = np.concatenate(([0], np.cumsum(np.bincount(t.text[stay], weights=np.diff(t.at)[stay], minlength=n)))).astype(np.int64)
            body = t.bytes[where].tobytes()
            kept = [body[a : b - 1].decode("utf-8", "replace") if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            n_words = np.bincount(t.text, minlength=n)
            n_gone = np.bincount(t.text[gone], minlength=n)
            rows.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), pa.array(n_gone), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"]))
        if not rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        return pa.Table.from_batches(rows)

    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, out)


def hot_minimisers(docs: DataFrame, blocks: int) -> np.ndarray:
    """Minimisers of more than HOT_SHARE of the distinct strings of a sample of blocks.

    The sample only decides which minimisers are spread by window; any choice gives the same result.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches, limit=CHUNK):
            t = Text(*W.raw(batch.column("text")))
            _, _, minimiser, key = super_kmers(t.hash, t.text, np.zeros(0, np.uint64))
            _, one = np.unique(key, return_index=True)
            found, count = np.unique(minimiser[one], return_counts=True)
            heavy = count > HOT_SHARE * len(one)
            yield pa.RecordBatch.from_arrays([pa.array(found[heavy].view(np.int64)), pa.array(count[heavy])], names=["minimiser", "n"])

    some = docs.where(W.by_share(F.col("block"), W.sample_share(blocks, HOT_SAMPLE_BLOCKS), 3))
    rows = some.select("text").mapInArrow(read, "minimiser bigint, n bigint").groupBy("minimiser").agg(F.sum("n").alias("n"))
    found = rows.orderBy(F.desc("n"), "minimiser").limit(HOT_LIMIT).collect()
    return np.sort(np.array([r["minimiser"] for r in found], np.int64).view(np.uint64))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept for every row of ``docs`` (doc_id, text)."""
    rows = blocked(docs)
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.approx_count_distinct("block").alias("blocks")).first()
    buckets = max(32, (size["bytes"] or 0) // BUCKET_BYTES + 1)
    hot = hot_minimisers(rows, size["blocks"])
    return cut(rows, answer(pack(rows, buckets, hot)), hot, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept string")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return deduplicated(W.documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
win AS (
  SELECT doc_id, i, md5_number(array_to_string(list_slice(w, i, i + 12), ' ')) AS h2
  FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)),
seen AS (SELECT h2, min(doc_id) AS least FROM win GROUP BY h2 HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, i FROM win JOIN seen USING (h2) WHERE least < doc_id), unnest(generate_series(i, i + 12)) AS t(p)),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(generate_series(1, len(w))) AS t(p)),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS body
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

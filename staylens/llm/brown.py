r"""Brown class-based bigram language model with exchange clustering.

Texts are lower-cased in A-Z; tokens are words ``[^\x20\x09-\x0D]+`` and one end
per text. Exchange clustering assigns every word to one of ``CLASSES`` classes:
each of the ``FREQUENT`` most frequent words is an item of its own, all other
words start as items by their ending. Items move one by one to the
class that raises the likelihood of the class bigrams most; each task moves its
share of the items against the counts of the last round. Then every other learnt word
moves on its own to the class that its own neighbours' classes favour most; the classes of these
words are a table, joined back by block. Words that no learning text holds keep the class of their ending. A token then costs
p(class | class before) * p(word | class), both smoothed; each class keeps mass for
one unseen word.

Counting is over all learning texts. Texts are cut and hashed once: a task packs
each chunk of its texts as the sorted distinct words and the places of the tokens in
that list. Only packed pieces of these lists travel, by range of the hash; back to a
chunk go the counts and classes of its words in the order of the list, and the chunk's
tokens meet them once. What reaches the driver is bounded by FREQUENT, SUFFIXES and CLASSES. A null text is empty: it has the end only. Rows
with the same key are scored one by one. Without learning texts every token is unseen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.llm.components import stored
from staylens.session import configure

FREQUENT, SUFFIXES, CLASSES, ROUNDS = 4096, 1024, 48, 8
SUFFIX_BYTES = 4
COUNT_BYTES = 6 << 20  # text of one chunk
KINDS_A_BUCKET = 400_000  # words of chunks that meet in one group
MOVED = 4096  # words that move at once against the same counts
FOLDS, HELD = 5, 1
TRANSITION_WEIGHT = 20.0
WIDE = 2 * CLASSES + 1  # cells of a word's contexts
END = FREQUENT + SUFFIXES  # the item of the end token; its class is the last one
OUT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


CHUNK = "chunk bigint, doc_id array<bigint>, learn array<boolean>, sizes array<int>, kinds int, words binary, endings binary, counts binary, tokens binary"
LINE = "doc_id array<bigint>, learn array<boolean>, sizes array<int>, seen array<bigint>, logs array<double>, line binary, follow binary"


def pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def unpack(packed: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed.as_py()), kind)


def _planes(values: np.ndarray) -> np.ndarray:
    """The bytes of 32-bit values, all first ones, then all second ones and so on: packs better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _values(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def blocked(docs: DataFrame) -> DataFrame:
    """Packed chunks of documents as their task reads them: doc_id, learn, number of tokens by text; the sorted words, their endings and counts in learning texts; tokens as places in the list of words."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(W.chunks(batches, limit=COUNT_BYTES)):
            tokens = Tokens(batch.column("text"))
            word, first, place = np.unique(tokens.words(), return_index=True, return_inverse=True)
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            count = np.bincount(place[learn[tokens.text]], minlength=len(word)).astype(np.uint32)
            ending = np.empty(len(word), np.uint16)
            order = np.argsort(first)
            ending[order] = tokens.endings(first[order])
            lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), x) for x in (batch.column("doc_id"), pa.array(learn), pa.array(np.bincount(tokens.text, minlength=tokens.n).astype(np.int32)))]
            binary = [pa.array([pack(x)], pa.binary()) for x in (word, ending, count, _planes(place))]
            columns = [pa.array([task + i]), *lists, pa.array([len(word)], pa.int32()), *binary]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in CHUNK.split(", ")])

    learn = W.remainder(F.col("doc_id"), FOLDS) != HELD
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", learn.alias("learn")).mapInArrow(read, CHUNK)


class Chunk:
    """One row of :func:`blocked` unpacked."""

    def __init__(self, table, row: int):
        column = {name: table.column(name)[row] for name in table.schema.names}
        self.learn = column["learn"].values.to_numpy(zero_copy_only=False)
        self.sizes = column["sizes"].values.to_numpy()
        self.tokens = _values(unpack(column["tokens"], np.uint8)) if "tokens" in column else None
        if "words" in column:
            self.words, self.endings = unpack(column["words"], np.uint64), unpack(column["endings"], np.uint16)
            self.counts = unpack(column["counts"], np.uint32)

    def learnt(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of the learning texts, their texts, and the number of these texts."""
        size = self.sizes[self.learn]
        return self.tokens[np.repeat(self.learn, self.sizes)], np.repeat(np.arange(len(size)), size), len(size)


def unpacked(batches) -> Iterator[Chunk]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Chunk(batch, row)


def edges(words: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, a range of hashes, begins in sorted words."""
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def bucket_rows(kinds: int | None) -> int:
    return max(8, (kinds or 0) // KINDS_A_BUCKET + 1)


class Tokens:
    """Words of lower-cased texts: where they stand and in which text; ``n`` texts."""

    def __init__(self, column: pa.Array):
        data, off = W.raw(column)
        self.data, self.n = W.LOWER[data], len(off) - 1
        self.start, self.end, self.text = W.spans(self.data, off)

    def words(self) -> np.ndarray:
        return W.hashes(self.data, self.start, self.end)

    def endings(self, at=slice(None)) -> np.ndarray:
        """The endings of the words ``at`` ascending places."""
        start, end = self.start[at], self.end[at]
        return (W.hashes(self.data, np.maximum(start, end - SUFFIX_BYTES), end, 3) % np.uint64(SUFFIXES)).astype(np.int32)


def words_of(column: pa.Array):
    """Hash, ending and text number of every word, and the number of texts."""
    tokens = Tokens(column)
    return tokens.words(), tokens.endings(), tokens.text, tokens.n


class Items:
    """Which clustering item a word is."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.sorted = frequent[self.order]

    def rank(self, word: np.ndarray) -> np.ndarray:
        """The items of frequent words, -1 for others."""
        if not len(self.sorted):
            return np.full(len(word), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, word), len(self.sorted) - 1)
        return np.where(self.sorted[at] == word, self.order[at], -1)

    def of(self, word: np.ndarray, ending: np.ndarray) -> np.ndarray:
        item = self.rank(word)
        return np.where(item >= 0, item, FREQUENT + ending.astype(np.int64))


def bigrams(docs: DataFrame, items: Items, buckets: int) -> DataFrame:
    """(a, b, n): how often item b follows item a in learning texts, ends included. Pairs travel packed, by remainder."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for chunk in unpacked(batches):
            token, text, n = chunk.learnt()
            line, _, _ = with_ends(items.of(chunk.words, chunk.endings)[token], text, n)
            pair, count = np.unique(line[:-1] * (END + 1) + line[1:], return_counts=True)
            order = np.argsort(pair % buckets, kind="stable")
            pair, count = pair[order], count[order].astype(np.uint32)
            edge = np.searchsorted(pair % buckets, np.arange(buckets + 1))
            # Ascending within a bucket, so steps are kept instead of values.
            rows = [(b, pack(_planes(np.diff(pair[x:y], prepend=0))), pack(count[x:y])) for b, (x, y) in enumerate(zip(edge[:-1], edge[1:])) if y > x]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "pairs", "counts"])

    def total(table: pa.Table) -> pa.Table:
        pair = np.concatenate([np.cumsum(_values(unpack(x, np.uint8))) for x in table.column("pairs")])
        count = np.concatenate([unpack(x, np.uint32) for x in table.column("counts")])
        pair, which = np.unique(pair, return_inverse=True)
        n = np.bincount(which, weights=count).astype(np.int64)
        return pa.table({"a": (pair // (END + 1)).astype(np.int32), "b": (pair % (END + 1)).astype(np.int32), "n": n})

    # The end that opens a chunk's line belongs to no text, but every later end also opens the next one.
    rows = docs.select("learn", "sizes", "words", "endings", "counts", "tokens").mapInArrow(read, "bucket bigint, pairs binary, counts binary")
    return rows.groupBy("bucket").applyInArrow(total, "a int, b int, n bigint")


def with_ends(value: np.ndarray, text: np.ndarray, n: int, end=END):
    """All texts in one line: an end, then each text's values and its end. Also the places of the values and of the closing ends."""
    count = np.bincount(text, minlength=n)
    line = np.full(len(value) + n + 1, end, np.asarray(value).dtype)
    place = np.arange(len(value)) + text + 1
    line[place] = value
    return line, place, np.cumsum(count + 1)


def neighbours(pairs: DataFrame) -> DataFrame:
    """One row an item: what follows it and what it follows, with counts; at most END + 1 entries each."""
    both = pairs.select(F.col("a").alias("item"), F.struct(F.lit(0).alias("side"), F.col("b").alias("other"), "n").alias("e")).unionAll(
        pairs.select(F.col("b").alias("item"), F.struct(F.lit(1).alias("side"), F.col("a").alias("other"), "n").alias("e"))
    )
    listed = both.groupBy("item").agg(F.array_sort(F.collect_list("e")).alias("e"))
    return listed.select("item", F.col("e.side").alias("side"), F.col("e.other").alias("other"), F.col("e.n").alias("n"))


def _entries(batch: pa.RecordBatch):
    item = batch.column("item").to_numpy()
    lists = batch.column("side")
    row = np.repeat(np.arange(len(item)), lists.value_lengths().to_numpy())
    side, other, n = (batch.column(c).flatten().to_numpy() for c in ("side", "other", "n"))
    return item, row, side, other, n.astype(float)


def class_counts(table: DataFrame, classes: np.ndarray) -> np.ndarray:
    """How often class d follows class c."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, row, side, other, n = _entries(batch)
            key = (classes[item[row]] * CLASSES + classes[other])[side == 0]
            sums = np.bincount(key, weights=n[side == 0], minlength=CLASSES * CLASSES)
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["key", "n"])

    out = np.zeros(CLASSES * CLASSES)
    for r in table.mapInArrow(read, "key bigint, n double").groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[r["key"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_class(m: np.ndarray, follow: np.ndarray, before: np.ndarray, own: float) -> int:
    """The class whose bigram likelihood gains most from an item that is taken out of ``m``."""
    cols, rows = np.flatnonzero(follow), np.flatnonzero(before)
    gain = (_f(m[:, cols] + follow[cols]) - _f(m[:, cols])).sum(1)
    gain += (_f(m[rows].T + before[rows]) - _f(m[rows].T)).sum(1)
    d = np.diag(m)
    gain -= _f(d + follow) - _f(d) + _f(d + before) - _f(d)
    gain += _f(d + follow + before + own) - _f(d)
    left, right = m.sum(1), m.sum(0)
    gain -= _f(left + follow.sum() + own) - _f(left) + _f(right + before.sum() + own) - _f(right)
    return int(gain[: CLASSES - 1].argmax())


def exchange(table: DataFrame, classes: np.ndarray, turn: int) -> np.ndarray:
    """One round: every second item moves to its best class, each task working on its own copy of the counts."""
    counts = class_counts(table, classes)

    def read(batches) -> Iterator[pa.RecordBatch]:
        m = counts.copy()
        for batch in batches:
            item, row, side, other, n = _entries(batch)
            size = len(item) * CLASSES
            key = row * CLASSES + classes[other]
            follow = np.bincount(key[side == 0], weights=n[side == 0], minlength=size).reshape(-1, CLASSES)
            before = np.bincount(key[side == 1], weights=n[side == 1], minlength=size).reshape(-1, CLASSES)
            same = (side == 0) & (other == item[row])
            own = np.bincount(row[same], weights=n[same], minlength=len(item))
            new = classes[item].copy()
            for i in np.flatnonzero((item != END) & ((item * 7 + turn) % 2 == 0)):
                c, r, b, s = new[i], follow[i].copy(), before[i].copy(), own[i]
                r[c] -= s
                b[c] -= s
                np.subtract(m[c], r, out=m[c])
                m[:, c] -= b
                m[c, c] -= s
                np.maximum(m, 0, out=m)
                new[i] = c = best_class(m, r, b, s)
                m[c] += r
                m[:, c] += b
                m[c, c] += s
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(new)], names=["item", "class"])

    out = classes.copy()
    for r in table.mapInArrow(read, "item int, class bigint").collect():
        out[r["item"]] = r["class"]
    return out


def cluster(table: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """A class for every item: first in turn by item number, then by exchange."""
    classes = np.arange(END + 1, dtype=np.int64) % (CLASSES - 1)
    classes[END] = CLASSES - 1
    for turn in range(rounds):
        classes = exchange(table, classes, turn)
    return classes


def contexts(docs: DataFrame, items: Items, classes: np.ndarray, buckets: int) -> DataFrame:
    """Packed by chunk and bucket: the words, their counts and first classes, and how often each word that is no item of its own stands before (cell class), behind (CLASSES + class) or next to itself (2 * CLASSES)."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("chunk").to_pylist()):
                chunk = Chunk(batch, i)
                item = items.of(chunk.words, chunk.endings)
                now = classes[item].astype(np.uint8)
                token, text, n = chunk.learnt()
                line, place, _ = with_ends(now[token], text, n, CLASSES - 1)
                same, _, _ = with_ends(token, text, n, -1)
                some = np.flatnonzero((item >= FREQUENT)[token])
                word, place = token[some], place[some]
                begins = same[place - 1] != word
                cell = np.concatenate((np.where(same[place + 1] == word, 2 * CLASSES, line[place + 1]), CLASSES + line[place - 1][begins]))
                key, n = np.unique(np.concatenate((word, word[begins])) * WIDE + cell, return_counts=True)
                entries = np.bincount(key // WIDE, minlength=len(now))
                ends = np.concatenate(([0], np.cumsum(entries)))
                edge = edges(chunk.words, buckets)
                rows = []
                for b, (x, y) in enumerate(zip(edge[:-1], edge[1:])):
                    if y > x:
                        part, at = slice(x, y), slice(ends[x], ends[y])
                        parts = (chunk.words[part], now[part], chunk.counts[part], entries[part].astype(np.uint8), (key[at] % WIDE).astype(np.uint8), n[at].astype(np.uint32))
                        rows.append((name, b, *map(pack, parts)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), *[pa.binary()] * 6))], names=["chunk", "bucket", "words", "now", "counts", "entries", "cells", "ns"])

    kinds = "chunk bigint, bucket bigint, words binary, now binary, counts binary, entries binary, cells binary, ns binary"
    return docs.select("chunk", "learn", "sizes", "words", "endings", "counts", "tokens").mapInArrow(read, kinds)


def best_classes(m: np.ndarray, row: np.ndarray, cell: np.ndarray, n: np.ndarray, now: np.ndarray) -> np.ndarray:
    """What :func:`best_class` finds for many words, each taken out of ``m`` alone: entries (row, cell, n) by row, ``now`` the class of each row."""
    size, each = len(now), np.arange(len(now))
    table = np.bincount(row * (2 * CLASSES + 1) + cell, weights=n, minlength=size * (2 * CLASSES + 1)).reshape(size, -1)
    follow, before, own = table[:, :CLASSES], table[:, CLASSES:-1], table[:, -1]
    gain = np.zeros((size, CLASSES))
    for first, counts, other in ((0, m.T, before), (CLASSES, m, follow)):
        at = np.flatnonzero((cell >= first) & (cell < first + CLASSES))
        if not len(at):
            continue
        r, d, k = row[at], cell[at] - first, n[at]
        left = counts[d]
        left[np.arange(len(at)), now[r]] -= k
        meets = np.flatnonzero(d == now[r])
        left[meets] -= other[r[meets]]
        left[meets, d[meets]] -= own[r[meets]]
        left = np.maximum(left, 0)
        begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        gain[r[begin]] += np.add.reduceat(_f(left + k[:, None]) - _f(left), begin)
    d = np.tile(np.diag(m), (size, 1))
    d[each, now] -= follow[each, now] + before[each, now] + own
    d = np.maximum(d, 0)
    gain += _f(d + follow + before + own[:, None]) - _f(d + follow) - _f(d + before) + _f(d)
    left, right = m.sum(1) - before, m.sum(0) - follow
    out, into = follow.sum(1) + own, before.sum(1) + own
    left[each, now] -= out
    right[each, now] -= into
    left, right = np.maximum(left, 0), np.maximum(right, 0)
    gain -= _f(left + out[:, None]) - _f(left) + _f(right + into[:, None]) - _f(right)
    return gain[:, : CLASSES - 1].argmax(1)


def solved(packed: DataFrame, classes: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Counts and classes of the words of each (chunk, bucket) of ``packed``, in their order, and under chunk -1 of each learnt word; each group moves its words against its own copy of the class counts."""

    def move(table: pa.Table) -> pa.Table:
        word, now, count, entries, cell, n = ([unpack(x, k) for x in table.column(c)] for c, k in (("words", np.uint64), ("now", np.uint8), ("counts", np.uint32), ("entries", np.uint8), ("cells", np.uint8), ("ns", np.uint32)))
        ends = np.cumsum([0, *map(len, word)])
        names, which = np.unique(np.concatenate(word), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(count)).astype(np.int64)
        own = np.empty(len(names), np.int64)
        own[which] = np.concatenate(now)
        key, at = np.unique(np.repeat(which, np.concatenate(entries)) * WIDE + np.concatenate(cell), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(n), minlength=len(key))
        owner, cell = key // WIDE, key % WIDE
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        moved, stops, m = owner[begin], np.append(begin, len(owner)), counts.copy()
        for a in range(0, len(moved), MOVED):
            b = min(a + MOVED, len(moved))
            part = slice(stops[a], stops[b])
            row, before = np.repeat(np.arange(b - a), np.diff(stops[a : b + 1])), own[moved[a:b]]
            found = best_classes(m, row, cell[part], n[part], before)
            for sign, at in ((-1, before[row]), (1, found[row])):
                c, k = cell[part], sign * n[part]
                x = np.where(c < CLASSES, at, np.where(c < 2 * CLASSES, c - CLASSES, at))
                y = np.where(c < CLASSES, c, at)
                m += np.bincount(x * CLASSES + y, weights=k, minlength=CLASSES * CLASSES).reshape(CLASSES, CLASSES)
            np.maximum(m, 0, out=m)
            own[moved[a:b]] = found
        own, learnt = own.astype(np.uint8), np.flatnonzero(total)
        parts = [which[x:y] for x, y in zip(ends[:-1], ends[1:])] + [learnt]
        return pa.table(
            {
                "chunk": pa.array([*table.column("chunk").to_pylist(), -1]),
                "bucket": pa.array([*table.column("bucket").to_pylist(), -1]),
                "words": pa.array([*[None] * (len(parts) - 1), pack(names[learnt])], pa.binary()),
                "counts": pa.array([pack(total[x]) for x in parts], pa.binary()),
                "classes": pa.array([pack(own[x]) for x in parts], pa.binary()),
            }
        )

    return packed.groupBy("bucket").applyInArrow(move, "chunk bigint, bucket bigint, words binary, counts binary, classes binary")


def named(found: DataFrame) -> DataFrame:
    """(word, class) of every learnt word of :func:`solved`."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, own in zip(batch.column("words"), batch.column("classes")):
                yield pa.RecordBatch.from_arrays([pa.array(unpack(word, np.int64)), pa.array(unpack(own, np.uint8).astype(np.int64))], names=["word", "class"])

    return found.where("chunk < 0").select("words", "classes").mapInArrow(read, "word bigint, class bigint")


def word_classes(packed: DataFrame, classes: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(word, class) for every learnt word of the ``packed`` contexts."""
    return named(solved(packed, classes, counts))


def classified(docs: DataFrame, found: DataFrame) -> DataFrame:
    """By chunk: the class of each token, how often a class follows another in learning texts, and of each text the number of learnt tokens and the sum of log10(count + 0.5)."""

    def read(texts: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("bucket").to_numpy())
        count, own = (np.concatenate([np.zeros(0, k), *[unpack(found.column(c)[int(i)], k) for i in order]]) for c, k in (("counts", np.int64), ("classes", np.uint8)))
        rows = []
        for i in range(texts.num_rows):
            chunk = Chunk(texts, i)
            n = len(chunk.sizes)
            text = np.repeat(np.arange(n), chunk.sizes)
            seen = np.bincount(text, weights=(count > 0)[chunk.tokens], minlength=n).astype(np.int64)
            logs = np.bincount(text, weights=np.log10(count + 0.5)[chunk.tokens], minlength=n)
            token, learnt, size = chunk.learnt()
            line, _, _ = with_ends(own[token].astype(np.int64), learnt, size, CLASSES - 1)
            follow = np.bincount(line[:-1] * CLASSES + line[1:], minlength=CLASSES * CLASSES)
            rows.append((*(texts.column(c)[i].as_py() for c in ("doc_id", "learn", "sizes")), seen, logs, pack(own[chunk.tokens]), pack(follow)))
        kinds = (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary(), pa.binary())
        columns = list(zip(*rows)) or [[]] * len(kinds)
        return pa.table({c.split()[0]: pa.array(x, k) for c, x, k in zip(LINE.split(", "), columns, kinds)})

    texts = docs.select("chunk", "doc_id", "learn", "sizes", "tokens")
    return texts.groupBy("chunk").cogroup(found.where("chunk >= 0").select("chunk", "bucket", "counts", "classes").groupBy("chunk")).applyInArrow(read, LINE)


def class_bigrams(lines: DataFrame) -> np.ndarray:
    """How often class d follows class c in learning texts, each word with its own class."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for x in batch.column("follow"):
                sums += unpack(x, np.int64)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["key", "n"])

    out = np.zeros(CLASSES * CLASSES)
    for r in lines.select("follow").mapInArrow(read, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[r["key"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


class Model:
    """Counts and classes; costs of tokens. ``known`` has the learnt words with their classes, ``lines`` the classes of the tokens of all texts."""

    def __init__(self, items: Items, classes: np.ndarray, follow: np.ndarray, tokens: np.ndarray, kinds: np.ndarray, texts: int, known: DataFrame, lines: DataFrame):
        self.known, self.lines = known, lines
        self.items, self.classes, self.texts = items, classes, texts
        self.tokens, self.kinds = int(tokens.sum()) + texts, int(kinds.sum()) + (texts > 0)
        share = (follow.sum(0) + 0.5) / (follow.sum() + 0.5 * CLASSES)
        self.step = np.log10((follow + TRANSITION_WEIGHT * share) / (follow.sum(1, keepdims=True) + TRANSITION_WEIGHT))
        self.emit = np.log10(tokens + 0.5 * (kinds + 1))  # denominator by class
        self.base = np.log10(self.tokens + 0.5 * (self.kinds + 1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "lines")}

    def score(self, sizes: np.ndarray, seen: np.ndarray, logs: np.ndarray, own: np.ndarray):
        """n_tokens, n_known, base and class score of each text; ``own`` are the classes of its tokens, ``logs`` its sum of log10(count + 0.5)."""
        n = len(sizes)
        text = np.repeat(np.arange(n), sizes)
        line, place, close = with_ends(own.astype(np.int64), text, n, CLASSES - 1)
        step = self.step[line[:-1], line[1:]]
        model = logs + np.bincount(text, weights=step[place - 1] - self.emit[own], minlength=n) + step[close - 1]
        base = logs - sizes * self.base + (np.log10(self.texts + 0.5) - self.base)
        return sizes.astype(np.int64) + 1, seen + (self.texts > 0), base, model


def class_sizes(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class over the learnt words of :func:`solved`."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for count, own in zip(batch.column("counts"), batch.column("classes")):
                at = unpack(own, np.uint8)
                sums = [np.bincount(at, weights=w, minlength=CLASSES).astype(np.int64) for w in (unpack(count, np.int64), None)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), *map(pa.array, sums)], names=["class", "tokens", "kinds"])

    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in found.where("chunk < 0").select("counts", "classes").mapInArrow(read, "class bigint, tokens bigint, kinds bigint").groupBy("class").agg(F.sum("tokens").alias("t"), F.sum("kinds").alias("k")).collect():
        tokens[r["class"]], kinds[r["class"]] = r["t"], r["k"]
    return tokens, kinds


def count_words(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(word, ending, c, first) of learnt words: c is the count over all chunks, first is true. Written to the shared folder."""
    buckets = bucket_rows(docs.agg(F.sum("kinds")).first()[0])

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in zip(*(batch.column(c) for c in ("words", "endings", "counts"))):
                word, ending, count = (unpack(x, k) for x, k in zip(parts, (np.uint64, np.uint16, np.uint32)))
                some = np.flatnonzero(count)
                word, ending, count = word[some], ending[some], count[some]
                edge = edges(word, buckets)
                rows = [(b, *(pack(v[x:y]) for v in (word, ending, count))) for b, (x, y) in enumerate(zip(edge[:-1], edge[1:])) if y > x]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))], names=["bucket", "words", "endings", "counts"])

    def total(table: pa.Table) -> pa.Table:
        word, ending, count = (np.concatenate([unpack(x, k) for x in table.column(c)]) for c, k in (("words", np.uint64), ("endings", np.uint16), ("counts", np.uint32)))
        word, first, which = np.unique(word, return_index=True, return_inverse=True)
        return pa.table({"word": word.view(np.int64), "ending": ending[first].astype(np.int32), "c": np.bincount(which, weights=count).astype(np.int64), "first": np.ones(len(word), bool)})

    packed = docs.select("words", "endings", "counts").mapInArrow(read, "bucket bigint, words binary, endings binary, counts binary")
    return stored(spark, packed.groupBy("bucket").applyInArrow(total, "word bigint, ending int, c bigint, first boolean"), "brown-words")


def learn(spark: SparkSession, docs: DataFrame, counted: DataFrame) -> Model:
    top = counted.orderBy(F.desc("c"), "word").limit(FREQUENT).select("word").collect()
    items = Items(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    size = docs.agg(F.sum("kinds").alias("kinds"), F.sum(F.size(F.filter("learn", lambda x: x))).alias("texts")).first()
    buckets = bucket_rows(size["kinds"])
    table = stored(spark, neighbours(bigrams(docs, items, buckets)), "brown-bigrams")
    classes = cluster(table)
    found = stored(spark, solved(contexts(docs, items, classes, buckets), classes, class_counts(table, classes)), "brown-classes")
    lines = stored(spark, classified(docs, found), "brown-lines")
    return Model(items, classes, class_bigrams(lines), *class_sizes(found), size["texts"] or 0, named(found), lines)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The digest columns for every row of the blocked ``docs`` that the model was made with, whose token classes it keeps."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, learn, sizes, seen, logs = (batch.column(c)[i].values for c in ("doc_id", "learn", "sizes", "seen", "logs"))
                size, known, base, mine = model.score(*(x.to_numpy() for x in (sizes, seen, logs)), unpack(batch.column("line")[i], np.uint8))
                held = np.logical_not(learn.to_numpy(zero_copy_only=False))
                total = np.full(len(size), model.tokens, np.int64)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (held, size, known, total, base, mine))], names=[c.split()[0] for c in OUT.split(", ")])

    return model.lines.drop("follow").mapInArrow(read, OUT)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = stored(spark, blocked(W.documents(spark, sf_dir)), "brown-chunks")
    counted = count_words(spark, docs)
    return score(docs, learn(spark, docs, counted))

"""Words of Arrow text columns as numpy arrays: spans, hashes, word windows.

Texts are read as UTF-8 bytes without building a Python string per word. A null
text counts as an empty one. Memory is bounded by the bytes of one chunk
(:func:`chunks`), or by one text where a single text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 3 << 19
HASH_BYTES = 1 << 16  # bytes whose running sums are held at once

# Separators of the word pattern [^\x20\x09-\x0D]+.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
# Lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(256 * seed + 1)) * _GOLDEN)


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Regroup Arrow batches so that each holds about ``limit`` bytes of ``column``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, done + limit - size, side="right")), at + (not held))
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - done
                at = to
            if at < batch.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and the n + 1 offsets of its texts."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def spans(data: np.ndarray, off: np.ndarray, solid: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text number of every word: a longest run of solid bytes in one text."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = np.concatenate(([False], solid[data], [False]))
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def flat(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all bytes of the given spans one after another, and where each span begins there."""
    size = end - start
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size), first


@lru_cache(8)
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's odd factor modulo 2**64 for the places of one block, and their inverses."""
    prime = 0x100000001B3 + 2 * seed
    return _power_row(prime, HASH_BYTES), _power_row(pow(prime, -1, 1 << 64), HASH_BYTES)


def _power_row(base: int, size: int) -> np.ndarray:
    row = np.full(size, base, np.uint64)
    row[:1] = 1
    return np.cumprod(row)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the bytes stand; the spans ascend.

    A span's polynomial is the difference of two running sums over its block of
    bytes, brought back to the span's first byte by the inverse power: exact modulo 2**64.
    """
    out = np.empty(len(start), np.uint64)
    values, at = _byte_values(seed), 0
    while at < len(start):
        low = int(start[at])
        to = max(int(np.searchsorted(end, low + HASH_BYTES - 1, side="right")), at + 1)
        s, e = start[at:to] - low, end[at:to] - low
        size = int(e[-1])
        if size < HASH_BYTES:
            power, inverse = _powers(seed)
        else:  # one long span, which starts at place 0
            power, inverse = _power_row(0x100000001B3 + 2 * seed, size), np.ones(1, np.uint64)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[low : low + size]] * power[:size], out=sums[1:])
        out[at:to] = (sums[e] - sums[s]) * inverse[s] + mix((e - s).astype(np.uint64))
        at = to
    return mix(out)


def windows(word: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``size`` consecutive words, and the first word of each; windows stay in one text."""
    n = len(word) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for i in range(size):
        value = value * np.uint64(0xD1342543DE82EF95) + word[i : n + i]
    first = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(value[first]), first


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[off[1:]] - sums[off[:-1]]


def sample_share(rows: int, wanted: int) -> float:
    """The share of rows to take for about ``wanted`` of them."""
    return min(1.0, wanted / max(rows, 1))


def by_share(key, share: float, salt: int):
    """Condition that holds for a fixed, hash-chosen share of the keys."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1_000_000)) < int(share * 1_000_000) + (share > 0)


def remainder(key, n: int):
    """crc32 of a key written as text, modulo ``n``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tallies(counted, limit: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Add up (word, n) arrays of one task; what is held stays near ``limit`` words."""
    held, size = [], 0

    def merged():
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for word, n in counted:
        held.append(pa.table({"word": word.cast(pa.large_string()), "n": n.cast(pa.int64())}))
        size += len(word)
        if size > 2 * limit:
            held = [merged()]
            size = held[0].num_rows
            if size > limit:
                yield from _batches(held[0])
                held, size = [], 0
    if held:
        yield from _batches(merged())


def _batches(table: pa.Table) -> Iterator[pa.RecordBatch]:
    return iter(table.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).combine_chunks().to_batches(max_chunksize=1 << 16))

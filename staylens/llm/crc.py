"""crc32 of many byte spans at once, and of spans written one after another.

crc32 is a state machine whose step is linear: the checksum of A followed by B is
the checksum of A moved on by B's length, xor the checksum of B. So words are read
once, and the checksums of all their combinations need a few table look-ups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from staylens.llm import words as W

SHORT = 64


def _byte_steps() -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    return step


_STEP = _byte_steps()


def _next(state: np.ndarray) -> np.ndarray:
    """The state after one zero byte."""
    return (state >> np.uint32(8)) ^ _STEP[state & np.uint32(255)]


def _moves() -> np.ndarray:
    """Row n moves a state on by n bytes: four tables of 256, one for each byte of the state."""
    rows = [np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHORT):
        rows.append(_next(rows[-1]))
    return np.stack(rows)


_MOVE = _moves()


def _apply(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (
        table[..., 0:256][..., state & 255]
        ^ table[..., 256:512][..., (state >> 8) & 255]
        ^ table[..., 512:768][..., (state >> 16) & 255]
        ^ table[..., 768:1024][..., state >> 24]
    )


def then(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksum of two byte strings one after another, from their checksums and the second one's size."""
    out = np.empty(len(first), np.uint32)
    flat = _MOVE.ravel()
    short = size <= SHORT
    base = np.where(short, size, 0).astype(np.int64) * 1024
    out[:] = flat[base + (first & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= flat[base + 256 * k + ((first >> np.uint32(8 * k)) & np.uint32(255))]
    for i in np.flatnonzero(~short):  # few: a span of more than SHORT bytes moves by powers of two
        out[i] = _far(first[i : i + 1], int(size[i]))[0]
    return out ^ second


def _far(state: np.ndarray, n: int) -> np.ndarray:
    table = _MOVE[1]
    while n:
        if n & 1:
            state = _apply(table, state)
        table = _apply(table, table)
        n >>= 1
    return state


def of_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each span of ``data``, byte by byte over all spans together."""
    size = end - start
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(-size, kind="stable")
    long = int(np.searchsorted(-size[order], -SHORT, side="left"))
    for i in order[:long]:
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes())
    rest = order[long:]
    state = np.full(len(rest), 0xFFFFFFFF, np.uint32)
    at, left = start[rest], -size[rest]
    for k in range(int(-left[0]) if len(rest) else 0):
        n = int(np.searchsorted(left, -k, side="left"))  # spans of more than k bytes come first
        head = state[:n]
        state[:n] = (head >> np.uint32(8)) ^ _STEP[(head ^ data[at[:n] + k]) & np.uint32(255)]
    out[rest] = ~state
    return out


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeStringArray:
    """The spans as an Arrow text column."""
    where, _ = W.flat(start, end)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[where])))

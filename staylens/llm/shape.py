"""Counts that describe how a text or line looks, shared by the line labeller and the quality classifier."""

from __future__ import annotations

import numpy as np

from staylens.llm import words

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_RANGE = np.arange(256)
_LETTER = ((_RANGE | 32) >= 97) & ((_RANGE | 32) <= 122) | (_RANGE >= 0xC3)
_UPPER = (_RANGE >= 65) & (_RANGE <= 90)
_DIGIT = (_RANGE >= 48) & (_RANGE <= 57)
_STOP = np.isin(_RANGE, [ord(c) for c in ".,;:!?"])
_SHOUT = np.isin(_RANGE, [ord(c) for c in "!?"])
_FIRST = (_RANGE & 0xC0) != 0x80  # first byte of a code point
N_SHAPE = 10


def code_points(data, off, solid=None) -> np.ndarray:
    flags = _FIRST[data] if solid is None else _FIRST[data] & solid[data]
    return words.per_text(flags, off)


def symbols(data, off) -> np.ndarray:
    return words.per_text(_SYMBOL[data], off)


def shape(data, off, n_words) -> np.ndarray:
    """One row of N_SHAPE numbers, each about 0 to 1, for each text (or line) of the buffer."""
    solid = code_points(data, off, words.SOLID)
    size = np.maximum(solid, 1)
    words_ = np.maximum(n_words, 1)
    letters = np.maximum(words.per_text(_LETTER[data], off), 1)
    return np.stack(
        [
            np.minimum(words.per_text(_SYMBOL[data], off) / size * 4, 2),
            words.per_text(_UPPER[data], off) / letters,
            np.minimum(words.per_text(_DIGIT[data], off) / size * 4, 2),
            np.minimum(words.per_text(_STOP[data], off) / words_, 2),
            np.minimum(words.per_text(_SHOUT[data], off) / words_, 2),
            np.minimum(words.per_text(data == 124, off) / words_, 2),
            np.minimum(solid / words_ / 8, 3),
            np.log1p(n_words) / 8,
            (n_words == 0).astype(float),
            np.minimum(letters / size, 1),
        ],
        axis=1,
    )


def repeated(hashes, text, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Flag of each word standing in a ``size``-word window that its text holds twice or more, and the windows' first words."""
    value, first = words.windows(hashes, text, size)
    hit = np.zeros(len(hashes), bool)
    if len(value):
        key = words.mix(value ^ words.mix(text[first].astype(np.uint64) + np.uint64(1)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = first[count[inverse] > 1]
        for i in range(size):
            hit[twice + i] = True
    return hit, first

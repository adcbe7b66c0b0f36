"""Simple-8b coding of non-negative integers, word-aligned and vectorised.

A 64-bit word holds a selector in its top four bits and, below it, as many values of
one width as 60 bits take.  Values of more than 60 bits are escapes: their word holds
the place of the raw value among the escaped values behind the coded words.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: bits a value for selectors 1 to 14, widest last.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = tuple(60 // width for width in WIDTHS)
ESCAPE = 0

_COUNT_OF = np.array([1, *COUNTS, 0], np.int64)
_LIMITS = np.array([1 << width for width in WIDTHS], np.uint64)
#: The least selector that holds each small value, which most token ids are.
_SMALL = 1 + np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _least(values: np.ndarray) -> np.ndarray:
    """The least selector wide enough for each value; one more than the last for escapes."""
    if values.max() < len(_SMALL):
        return _SMALL[values.astype(np.uint16)]
    return 1 + np.searchsorted(_LIMITS, values, "right").astype(np.uint8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """At each place the selector that packs most of the values from there on.

    The least selector of ``count`` values is the greatest one of theirs, taken over
    windows that double; places behind the last value need none.
    """
    n = len(values)
    least = _least(values)
    windows = {1: np.concatenate([least, np.zeros(COUNTS[0], np.uint8)])}

    def window(count: int) -> np.ndarray:
        if count not in windows:
            half = window((count + 1) // 2)
            other = half[count // 2 :]
            windows[count] = np.maximum(half[: len(other)], other)
        return windows[count]

    select = np.where(least > len(WIDTHS), ESCAPE, len(WIDTHS)).astype(np.uint8)
    widest = int(least.max())
    for selector in range(len(WIDTHS) - 1, 0, -1):
        fits = window(COUNTS[selector - 1])[:n] <= selector
        if selector >= widest:
            select[:] = selector
        elif fits.any():
            select[fits] = selector
        else:
            break  # nor does a narrower one, which takes more values
    return select


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coded words and escaped values, both uint64.  Of no values: two empty arrays.

    Each word takes the selector that packs most of the next values.  The last word
    may be filled up with zeros, so the number of values has to be stored beside.
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    select = _selectors(values)
    takes = _COUNT_OF[select].tolist()
    begins, place = [], 0
    while place < n:
        begins.append(place)
        place += takes[place]
    begin = np.array(begins)
    chosen = select[begin]
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
            continue
        width, count = WIDTHS[selector - 1], COUNTS[selector - 1]
        for k in range(count):
            words[rows] |= padded[begin[rows] + k] << np.uint64(k * width)
    return words, values[begin[chosen == ESCAPE]]


def decode(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of ``encode``, one scatter for each selector in use."""
    words = np.ascontiguousarray(words, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    takes = _COUNT_OF[chosen]
    begin = np.cumsum(takes) - takes
    values = np.zeros(int(takes.sum()), np.uint64)
    for selector in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == selector)
        body = words[rows] & np.uint64((1 << 60) - 1)
        if selector == ESCAPE:
            values[begin[rows]] = escaped[body.astype(np.int64)]
            continue
        width, count = WIDTHS[selector - 1], COUNTS[selector - 1]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            values[begin[rows] + k] = body >> np.uint64(k * width) & mask
    return values[:n]

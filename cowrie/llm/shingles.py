"""Hashed word shingles of whole texts."""

from __future__ import annotations

import hashlib

import numpy as np

#: Words whose hashes a worker remembers, about 20 MB.
WORDS_KEPT = 100_000

# White space cuts; A-Z are lower-cased.  In UTF-8 every byte of a character beyond
# ASCII is 128 or more, so bytes cut as characters do.
_FOLD = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_HASHES = _Hashes()


def forget_words() -> None:
    """Drops the words a worker remembers: it lives on, idle or in other stages."""
    _HASHES.clear()


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles of a text, ascending.

    A text of fewer words, but not none, has its whole word sequence as the only one;
    null texts and texts without a word have none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ")
    hashes = np.fromiter((_HASHES[w] for w in words if w), np.uint64)
    if not len(hashes):
        return hashes
    size = min(n, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total + _PRIME) + hashes[k : k + len(total)]
    return np.unique(mixed(total))


def set_id(tokens: np.ndarray) -> bytes:
    """16 bytes that tell sets apart."""
    return hashlib.blake2b(tokens.astype("<u8").tobytes(), digest_size=16).digest()

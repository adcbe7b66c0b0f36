"""Fast exact encoding of whole texts with a file of the tokenizers library.

Most words of a corpus repeat, so each worker keeps the ids of the words it has met.
A text is cut only where the tokenizer's own rules always cut; any text for which
that isn't certain is encoded in one piece.  Ids are therefore those of
``Tokenizer.encode(text, add_special_tokens=False)``, which a test compares.
"""

from __future__ import annotations

import json
import os
import re
import struct
from itertools import chain, islice

import numpy as np

#: Entries of a worker's memory of words: about 65 MB.  Commas and full stops behind words are
#: kept apart, so most of a corpus's words are in it.
WORDS_KEPT = 300_000

# A run of letters whose case and composition are plain, then a run of ASCII marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
# One mark between a letter and white space or the end: always a word of its own to the tokenizer.
_MARKED = re.compile(r"[,.](?<=[A-Za-zÀ-ÖØ-öø-ÿ][,.])(?=[ \n]|\Z)")
_GLUED = "\x01"  # before a mark that has no space before it in the text
_OTHER_SPACE = re.compile(r"[^\S \n]")
# White space in ASCII other than a space and a line end, and what isn't single or inside.
_NOT_SINGLE = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
_ENDS = (" ", "\n")
# Characters that Python counts as white space and tokenizers may not.
_ODD_SPACES = "\x1c\x1d\x1e\x1f\x85\u180e\u200b\ufeff"


def _byte_letters() -> dict[int, str]:
    """The letter byte-level tokenizers write each byte as: itself if printable, else the next one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_SPACE = _BYTE_LETTERS[0x20]


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _code(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACKS[n](*ids) if n < len(_PACKS) else struct.pack(f"<{n}I", *ids)


def _single_spaced(text: str) -> bool:
    """Whether every white space is one space or one line end between two words, of which there is one."""
    if text.isascii():
        return bool(text) and not (
            text.startswith(_ENDS) or text.endswith(_ENDS) or any(w in text for w in _NOT_SINGLE)
        )
    return 1 + text.count(" ") + text.count("\n") == len(text.split()) and not _OTHER_SPACE.search(text)


class _Kept(dict):
    """Keeps what ``make`` gave for a key; at ``most`` entries the older half goes."""

    def __init__(self, make, most: int) -> None:
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)  # may keep a part of the key too
        if len(self) >= self.most:
            for old in list(islice(self, len(self) - self.most // 2)):
                del self[old]
        self[key] = value
        return value


class Encoder:
    """Encodes texts; ids come as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        cut = rules.get("pre_tokenizer") or {}
        first = (cut.get("pretokenizers") or [{}])[0]
        norms = [n["type"] for n in (rules.get("normalizer") or {}).get("normalizers", [])]
        self.special = tuple(t["content"] for t in rules.get("added_tokens", []))
        self.lower = norms[-1:] == ["Lowercase"]
        if rules.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") \
                and not cut.get("add_prefix_space"):
            self.encode = self._spaced  # a space belongs to the word after it
        elif norms == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split" and first.get("invert"):
            self.encode = self._unspaced  # white space only separates
        else:
            self.encode = self.whole
        self._model = self.tokenizer.model
        self._marks = _Kept(self.whole, WORDS_KEPT)
        self._inner = _Kept(self._after_space, WORDS_KEPT)
        self._first = _Kept(self._alone, WORDS_KEPT)

    def whole(self, text: str) -> bytes:
        return _code(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _stem(self, stem: str) -> bytes:
        """A run of plain letters is one word to the model: no need to normalise and cut it."""
        if not stem.isascii():
            stem = stem.encode().decode("latin-1").translate(_BYTE_LETTERS)
        elif stem[0] == " ":
            stem = _SPACE + stem[1:]
        return _code([token.id for token in self._model.tokenize(stem)])

    def _after_space(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and not self.lower:
            return _code([token.id for token in self._model.tokenize(_SPACE + word)])
        if word[:1] == _GLUED:
            return self._marks[word[1:]]
        return self._word(" ", word)

    def _alone(self, word: str) -> bytes:
        return self._word("", word)

    def _word(self, before: str, word: str) -> bytes:
        if not (word.isascii() and word.isalpha()):
            plain = _PLAIN.fullmatch(word)
            if not plain:
                return self.whole(before + word)
            stem, marks = plain.groups()
            if marks:  # the stem is a word that may be at hand
                return (self._inner if before else self._first)[stem] + self._marks[marks]
        if self.lower and word != (lower := word.lower()):
            return self._first[lower]
        return self._stem(before + word)

    def _spaced(self, text: str) -> bytes:
        if not _single_spaced(text) or _GLUED in text or any(s in text for s in self.special):
            return self.whole(text)
        first, inner, end = self._first, self._inner, self._marks["\n"]
        parts = []
        for line in _MARKED.sub(rf" {_GLUED}\g<0>", text).split("\n"):
            words = line.split(" ")
            parts.append(first[words[0]])
            parts.extend(map(inner.__getitem__, words[1:]))
            parts.append(end)
        return b"".join(parts[:-1])

    def _unspaced(self, text: str) -> bytes:
        if any(s in text for s in chain(self.special, _ODD_SPACES)):
            return self.whole(text)
        return b"".join(map(self._first.__getitem__, _MARKED.sub(r" \g<0>", text).split()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drops this worker's encoders and the words they keep, for stages that encode nothing."""
    _ENCODERS.clear()

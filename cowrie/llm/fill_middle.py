"""Fill-in-the-middle texts by rotating blocks of a bytearray in place.

A text is cut into prefix, middle and suffix.  Its UTF-8 bytes are scanned once for the
cuts and go into one bytearray with a sentinel before each part, in reading order:
``<P>prefix<M>middle<S>suffix``.  The output form is a rotation of blocks of it:

* ``psm`` exchanges the last two blocks: ``<P>prefix<S>suffix<M>middle``;
* ``spm`` exchanges the suffix with all before it: ``<S>suffix<P>prefix<M>middle``;
* ``plain`` is the text itself, without sentinels.

Two neighbouring blocks are exchanged by three reversals: of each block and of both
together.  ``restore`` finds the sentinels of an output, rotates back and takes the
sentinels out, which gives the text exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cowrie.llm.slices import bounded

# The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes that a reversal holds besides the text.
STEP = 1 << 16


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts ``transformed`` are cut; of a hundred of those ``spm`` begin with the suffix."""

    transformed: int = 90
    spm: int = 20
    seed: str = "1"


def reverse(view: np.ndarray, begin: int, end: int) -> None:
    """Reverses ``view[begin:end]`` in place, exchanging steps from both ends."""
    while end - begin > 1:
        step = min(STEP, (end - begin) // 2)
        left = view[begin : begin + step][::-1].copy()
        view[begin : begin + step] = view[end - step : end][::-1]
        view[end - step : end] = left
        begin, end = begin + step, end - step


def rotate(buffer: bytearray, begin: int, middle: int, end: int) -> None:
    """Exchanges the blocks ``[begin:middle]`` and ``[middle:end]`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, begin, middle)
    reverse(view, middle, end)
    reverse(view, begin, end)


def scan(text: bytes, cuts: tuple[int, int]) -> tuple[int, int]:
    """Byte places of two cuts given in code points, ascending, found in one scan in steps.

    A code point begins at each byte that is no continuation byte.
    """
    places, seen, wanted = [], 0, list(cuts)
    for at in range(0, len(text), STEP):
        part = np.frombuffer(text, np.uint8, min(STEP, len(text) - at), at)
        begins = np.flatnonzero((part & 0xC0) != 0x80)
        while wanted and wanted[0] < seen + len(begins):
            places.append(at + int(begins[wanted.pop(0) - seen]))
        seen += len(begins)
        if not wanted:
            break
    return tuple(places + [len(text)] * len(wanted))  # a cut after the last code point


def draws(doc_id: int | None, seed: str) -> tuple[int, ...]:
    """Four 32-bit numbers from the sha256 of ``seed:doc_id``; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def transformed(text: str, doc_id: int | None, rates: Rates) -> tuple[str, bytes, int | None, int | None]:
    """Form, output bytes, and code points of prefix and middle (None where plain)."""
    code = text.encode()
    h1, h2, h3, h4 = draws(doc_id, rates.seed)
    if not code or h3 % 100 >= rates.transformed or any(s in code for s in SENTINELS):
        return PLAIN, code, None, None
    n = len(text)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = scan(code, (first, second))
    buffer = bytearray(code)
    for place, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):  # the last first, so that places hold
        buffer[place:place] = sentinel
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    form = SPM if h4 % 100 < rates.spm else PSM
    rotate(buffer, 0 if form == SPM else middle, suffix, len(buffer))
    return form, bytes(buffer), first, second - first


def restored(output: bytes, form: str) -> bytes:
    """The text of an output and its form.

    Parts hold no sentinel and a sentinel can't begin inside another or in what comes
    before it, so the first of each is the inserted one.
    """
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    if form == SPM:
        prefix = buffer.index(PREFIX)
        rotate(buffer, 0, prefix, len(buffer))
        begin = len(buffer) - prefix  # of the suffix's sentinel
        middle -= prefix
    else:
        rotate(buffer, suffix, middle, len(buffer))
        begin = suffix + len(buffer) - middle
        middle = suffix
    for place, sentinel in ((begin, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[place : place + len(sentinel)]
    return bytes(buffer)


_FORMED = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])


def transform(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole ``docs (doc_id, text)``.

    ``n`` counts code points.  Null and empty texts are plain with ``n`` 0 and an empty
    output, as are texts with a sentinel of their own (plain, unchanged); an empty table
    gives no rows.  Repeated rows and ids are transformed alike, each by itself, and a
    null id is drawn for as no digits.  Other columns, whatever their names, are not read.
    """

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                text = text or ""
                kind, output, prefix, middle = transformed(text, doc_id, rates)
                rows.append((doc_id, len(text), kind, prefix, middle, output.decode()))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _FORMED)]
            yield pa.RecordBatch.from_arrays(columns, schema=_FORMED)

    return docs.select("doc_id", "text").mapInArrow(
        form, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` with ``restored``, the exact text rebuilt from ``output`` and ``form`` alone.

    All columns of ``rows`` stay but one named ``restored``, which is replaced.  A null
    output or form gives null.
    """
    kept = rows.drop("restored")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded(batches, "output"):
            pairs = zip(part.column("output").to_pylist(), part.column("form").to_pylist())
            texts = [None if o is None or f is None else restored(o.encode(), f).decode() for o, f in pairs]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "restored"]
            )

    return kept.mapInArrow(rebuild, f"{schema}, restored string")

"""Fill-in-the-middle against plain string slicing, and exact round trips."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cowrie.llm import fill_middle, slices
from cowrie.llm.fill_middle import Rates, restored, rotate, scan, transformed

from against_sql import same_as_sql

TEXTS = st.text(alphabet=st.sampled_from("ab<>PSM é日\U0001f600\n"), max_size=40)


def expected(text, doc_id, rates=Rates()):
    """The rule in plain string slices."""
    digits = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[k : k + 8], 16) for k in (0, 8, 16, 24))
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rates.transformed:
        return "plain", text, None, None
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rates.spm:
        return "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", a, b - a
    return "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", a, b - a


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.sampled_from([0, 20, 100]))
def test_any_text(text, doc_id, spm):
    rates = Rates(transformed=100, spm=spm)
    form, output, prefix, middle = transformed(text, doc_id, rates)
    assert (form, output.decode(), prefix, middle) == expected(text, doc_id, rates)
    assert restored(output, form) == text.encode()


@pytest.mark.parametrize("tail", ["<", "<S", "<<", "<M", "<P", ">", "S>", "M>"])
@pytest.mark.parametrize("spm", [0, 100])
def test_parts_that_end_or_begin_like_sentinels(tail, spm):
    for text in (tail, tail * 2, "a" + tail, tail + "a", f"a{tail}b{tail}"):
        for doc_id in range(60):
            form, output, *_ = transformed(text, doc_id, Rates(100, spm))
            assert (form, output.decode()) == expected(text, doc_id, Rates(100, spm))[:2]
            assert restored(output, form) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200), st.data())
def test_rotation(code, data):
    begin, middle, end = sorted(data.draw(st.integers(0, len(code))) for _ in range(3))
    buffer = bytearray(code)
    rotate(buffer, begin, middle, end)
    assert bytes(buffer) == code[:begin] + code[middle:end] + code[begin:middle] + code[end:]


def test_steps_smaller_than_the_text(monkeypatch):
    monkeypatch.setattr(fill_middle, "STEP", 3)
    text = "aé日\U0001f600" * 50
    for doc_id in range(40):
        form, output, *_ = transformed(text, doc_id, Rates())
        assert (form, output.decode()) == expected(text, doc_id)[:2]
        assert restored(output, form) == text.encode()
    assert scan("é日".encode(), (0, 2)) == (0, 5)


def test_very_long_text():
    text = "é a long text 日 " * 400_000
    form, output, *_ = transformed(text, 5, Rates(100, 100))
    assert (form, output.decode()) == expected(text, 5, Rates(100, 100))[:2]
    assert restored(output, form) == text.encode()


def test_slices_are_bounded():
    texts = ["x" * n for n in (5, 5_000_000, 3, 3)] + ["y"] * 600 + [None, ""]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(slices.bounded([batch.slice(0, 0), batch], "text"))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    for part in parts:
        size = sum(len(t or "") for t in part.column("text").to_pylist())
        assert part.num_rows == 1 or (part.num_rows <= slices.MOST_ROWS and size <= slices.MOST_BYTES)


def test_edges(spark, rows):
    docs = rows(
        "doc_id long, text string, form int, output int, restored int, n string",
        (1, None, 1, 1, 1, "a"), (2, "", 1, 1, 1, "a"), (3, "one two <P> three", 1, 1, 1, "a"),
        (4, "one two three", 1, 1, 1, "a"), (4, "one two three", 1, 1, 1, "a"), (4, "other", 2, 1, 1, "a"),
        (None, "no id", 1, 1, 1, "a"), (5, "x" * 300_000, 1, 1, 1, "a"),
    )
    got = fill_middle.restore(fill_middle.transform(docs)).collect()
    want = [(d, len(t or ""), *expected(t or "", d), t or "") for d, t, *_ in docs.collect()]
    in_order = [(r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"], r["restored"]) for r in got]
    assert sorted(map(repr, in_order)) == sorted(map(repr, want))
    assert fill_middle.transform(docs.where("false")).count() == 0
    assert fill_middle.restore(fill_middle.transform(docs).where("false")).count() == 0
    hollow = rows("doc_id long, output string, form string, restored int", (1, None, "psm", 0), (2, "x", None, 0))
    assert [r["restored"] for r in fill_middle.restore(hollow).collect()] == [None, None]


def test_query(spark):
    same_as_sql(spark, "op13_fill_middle")

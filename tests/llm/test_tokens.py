"""Encoding, Simple-8b, token files and packing against direct computations."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cowrie.llm import packing, simple8b, token_files, tokens
from cowrie.llm.queries import QUERIES
from cowrie.llm.tokens import encoder
from cowrie.session import shared_folder

SF = "/root/testdata/sf0.001"
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TRICKY = [
    "", " ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\nb", "a\tb", "don't stop", "it's.", "x'", "''s",
    "<|endoftext|> a <|endoftext|>", "<|startoftext|>b", "ÉCOLE, Straße!", "İstanbul ΣΑΣ", "é àb",
    "12 34.5%", "__a__", "a b", "a\x1cb\x85c", "日本語 テスト。", "a\r\nb", "Word.Word,word!!", "\U0001f600 ok",
    "a​b ﻿ c", "The\nend.\nOf it", "ﬁn ½", "\n", "ok\n",
]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_library(spark, name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for text in texts:
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(path).encode(text), "<u4").tolist() == expected, text[:80]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé 'ts.\n\t1_<|>ß"), max_size=30), st.sampled_from(FILES))
def test_encoder_on_any_text(text, name):
    own = encoder(public_tokenizers.path(name))
    expected = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(values):
    words, escaped = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, escaped, len(values)).tolist() == values


def test_simple8b_is_compact():
    words, _ = simple8b.encode(np.ones(6000, np.uint64))
    assert len(words) == 100
    words, escaped = simple8b.encode(np.array([1 << 60, 5], np.uint64))
    assert escaped.tolist() == [1 << 60] and len(words) == 2


def expected_ids(texts, name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_file_query(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    at, expected = 0, []
    for (doc_id, _), ids in zip(docs, expected_ids([d[1] for d in docs], FILES[0])):
        expected.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op4_token_files"](spark, SF).collect())) == expected


def test_token_file_edges(spark, rows):
    long = "the end of it. " * 30_000
    docs = rows(
        "doc_id long, part int, text string", (5, 1, None), (3, 1, ""), (3, 1, "b"), (9, 1, long), (None, 1, "x"), (7, 1, "a")
    )
    path = shared_folder(spark, "test")
    token_files.write(docs, path, public_tokenizers.path(FILES[0]))
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    texts = ["x", "", "b", None, "a", long]
    assert [r["doc_id"] for r in got] == [None, 3, 3, 5, 7, 9]
    assert [r["ids"] for r in got] == expected_ids(texts, FILES[0])
    empty = shared_folder(spark, "test")
    token_files.write(docs.where("false"), empty, public_tokenizers.path(FILES[0]))
    assert token_files.read(spark, empty).count() == 0


def check_packed(got, lengths_by_doc, capacity):
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, total in lengths_by_doc.items():
        whole = [(k, s, min(capacity, total - s)) for k, s in enumerate(range(0, total, capacity))]
        assert sorted(by_doc.pop(doc_id)) == whole
    assert not by_doc
    return len(by_sequence)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([d[0] for d in docs], expected_ids([d[1] for d in docs], FILES[1])))
    got = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    used = check_packed(got, {k: len(v) for k, v in ids.items()}, 2048)
    assert all(r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]) for r in got)
    assert used <= math.ceil(sum(map(len, ids.values())) / 2048) + 1


def test_packing_edges(spark, rows):
    docs = rows("doc_id long, text string, length int", (1, None, 0), (2, "", 0), (3, "a b c d e f", 0), (4, "a " * 50, 0))
    got = packing.packed(docs, public_tokenizers.path(FILES[1]), capacity=8, ids=True).collect()
    assert check_packed(got, {1: 1, 2: 1, 3: 7, 4: 51}, 8) == 8
    assert b"".join(r["ids"] for r in sorted(got, key=lambda r: r["piece"]) if r["doc_id"] == 3)[-4:] == b"\0" * 4
    assert packing.packed(docs.where("false"), public_tokenizers.path(FILES[1])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=30, max_size=30))
def test_plan_uses_every_piece_once(counts):
    counts = np.array([0, *counts])
    used = np.zeros_like(counts)
    for lengths, times in packing.plan(counts):
        assert sum(lengths) <= 30 and times > 0
        for x in lengths:
            used[x] += times
    assert used.tolist() == counts.tolist()
    places = packing.Places.of(packing.plan(counts))
    taken = set()
    for length in np.flatnonzero(counts):
        sequence, offset = places.find(np.full(counts[length], length), np.arange(counts[length]))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            new = {(s, o + k) for k in range(int(length))}
            assert not new & taken
            taken |= new


def test_hot_length(spark):
    pieces = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(700).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"),
    )
    before = packing.RANKED_TOGETHER
    packing.RANKED_TOGETHER = 300
    try:
        got = packing.pack(pieces).collect()
    finally:
        packing.RANKED_TOGETHER = before
    assert check_packed(got, {k: 700 for k in range(5000)}, 2048) == 2500


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_white_space_and_marks_that_only_look_plain(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    for text in ("ñ\n\xa0\xa0\x1cß Āé", "don't, a. b!, c.. d,e ,f\x01, g", "é, Ünd.\nlast,", "a \x01, b", "Ā, ﬁ."):
        wanted = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(path).encode(text), "<u4").tolist() == wanted


def test_words_kept_are_bounded():
    kept = tokens._Kept(str.encode, 10)
    for k in range(1000):
        assert kept[f"w{k}"] == f"w{k}".encode() and kept["often"] == b"often"
        assert len(kept) + len(getattr(kept, "last", ())) <= 10

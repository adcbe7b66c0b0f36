"""Packing on the histogram against packs filled one by one, and whole results against the tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cowrie.llm import shortest_pack
from cowrie.llm.queries import QUERIES
from cowrie.llm.shortest_pack import Places, closed, pack, shortest_first

FILE = public_tokenizers.path("byte_bpe_50k.json")
COUNTS = st.lists(st.one_of(st.just(0), st.integers(0, 4), st.integers(0, 60)), min_size=31, max_size=31)


def one_by_one(counts, capacity):
    """Totals of packs when each length, longest first, goes into the shortest pack."""
    packs = []
    for length in range(capacity, 0, -1):
        for _ in range(counts[length]):
            shortest = min(range(len(packs)), key=packs.__getitem__, default=None)
            if shortest is None or packs[shortest] + length > capacity:
                packs.append(length)
            else:
                packs[shortest] += length
    return sorted(packs)


@settings(max_examples=150, deadline=None)
@given(COUNTS)
def test_counts_of_patterns_equal_single_packs(counts):
    counts = np.array([0, *counts, 0])
    patterns = shortest_first(counts)
    assert sorted(t for p in patterns for t in [p.total] * p.times) == one_by_one(counts, 32)


@settings(max_examples=300, deadline=None)
@given(COUNTS, st.sampled_from([1, 4, 9]))
def test_every_token_has_one_place_and_gaps_are_small(counts, least):
    counts = np.array([0, *counts, 0])
    patterns = closed(shortest_first(counts), 32, least)
    assert all(p.times > 0 and (p.total > 32 - least or p.total & (p.total - 1) == 0) for p in patterns)
    assert sum(p.times for p in patterns if p.total <= 32 - least) <= 5 + sum(
        p.times for p in shortest_first(counts) if p.total <= 32 - least and p.total & (p.total - 1) == 0
    )
    places, used, tokens = Places.of(patterns, 32), {}, 0
    whole = np.repeat(np.arange(33), counts)
    rank = np.concatenate([np.arange(c) for c in counts]).astype(np.int64)
    seen = [0] * len(whole)
    for row, start, length, sequence, offset in places.find(whole, rank):
        for r, s, n, q, o in zip(row, start, length, sequence, offset):
            assert s == seen[r] and n > 0 and 0 <= q < places.sequences
            seen[r] += n
            for k in range(o, o + n):
                assert used.setdefault((q, k), r) == r
            tokens += n
    assert seen == whole.tolist() and len(used) == tokens == int((counts * np.arange(33)).sum())


def test_plan_of_a_large_histogram_is_small():
    draw = np.random.default_rng(3)
    counts = draw.integers(0, 10**7, 1025)
    counts[1024] = 0
    patterns = closed(shortest_first(counts), 1024)
    tokens = int((counts * np.arange(1025)).sum())
    assert sum(p.total * p.times for p in patterns) == tokens
    assert sum(len(p.parts) for p in patterns) < 100_000
    assert sum((1024 - p.total) * p.times for p in patterns if p.total & (p.total - 1)) < tokens / 100


def expected_ids(texts):
    t = Tokenizer.from_file(FILE)
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def check(got, ids, capacity):
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and (at & (at - 1) == 0 or at > capacity - shortest_pack.LEAST)
    assert set(by_doc) == set(ids)
    for doc_id, rows in by_doc.items():
        at, whole = 0, ids[doc_id]
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(whole)
            at += r["length"]
            code = np.array(whole[r["start"] : at], "<u4")
            assert r["ids_crc32"] == zlib.crc32(code.tobytes())
            if "ids" in r:
                assert np.frombuffer(r["ids"], "<u2").tolist() == code.tolist()
        assert at == len(whole)
    return len(by_sequence)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([d[0] for d in docs], expected_ids([d[1] for d in docs])))
    result = QUERIES["op12_shortest_pack"](spark, folder)
    assert result.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = result.collect()
    total = sum(map(len, ids.values()))
    assert check(got, ids, 1024) <= -(-total // 1024) * 1.02 + 40
    assert len(got) <= len(docs) + 3 * total / 1024  # few documents are cut more than they must


@pytest.mark.parametrize("together", [1000, 2])
def test_edges(spark, rows, together, monkeypatch):
    monkeypatch.setattr(shortest_pack, "RANKED_TOGETHER", together)
    docs = rows(
        "doc_id long, text string, length int, number int, ids string, _lot int",
        (1, None, 0, 0, "", 0), (2, "", 0, 0, "", 0), (3, "a b c d e f", 0, 0, "", 0), (4, "one two three " * 3000, 0, 0, "", 0),
        (5, "x y z", 0, 0, "", 0), (6, "x y z", 0, 0, "", 0), (7, "é<|endoftext|> ok", 0, 0, "", 0), (8, "a b c d e f g", 0, 0, "", 0),
    )
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = dict(zip(texts, expected_ids(texts.values())))
    check(pack(docs, FILE, 8, ids=True).collect(), ids, 8)
    check(pack(docs, FILE, 1, ids=True).collect(), ids, 1)
    check(pack(docs, FILE).collect(), ids, 1024)
    assert pack(docs.where("false"), FILE).count() == 0
    with pytest.raises(ValueError):
        pack(docs, FILE, 1000)


def test_repeated_rows_and_ids(spark, rows):
    """Copies of a row, other texts under one id and null ids each keep all their tokens."""
    docs = rows("doc_id long, text string", *[(1, "a b c")] * 300, *[(None, "a b c d")] * 300, (1, "e"), (1, None))
    sizes = {x: len(expected_ids([x])[0]) for x in ("a b c", "a b c d", "e", None)}
    got = pack(docs, FILE, 16).collect()
    tokens = {}
    for r in got:
        tokens[r["doc_id"], r["doc_tokens"]] = tokens.get((r["doc_id"], r["doc_tokens"]), 0) + r["length"]
    wanted = {}
    for r in docs.collect():
        key = r["doc_id"], sizes[r["text"]]
        wanted[key] = wanted.get(key, 0) + sizes[r["text"]]
    assert tokens == wanted
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)

"""The window scan against a brute-force search."""

import hashlib
import re

import pytest

from cowrie.llm import decontaminate
from cowrie.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item_id, text in items:
        w = words(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                items_here = windows.get(tuple(w[k : k + size]))
                if items_here:
                    hit.update(range(k, k + size))
                    found |= items_here
        digest = hashlib.sha256(",".join(sorted(str(i) for i in found if i is not None)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found - {None}), digest, bool(hit)))
    return sorted(out, key=repr)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    got = QUERIES["op2_benchmark_decontamination"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)
    assert any(r["contaminated"] for r in got)


TEXT = "One two, three four five six seven eight nine ten eleven"
DOCS = [
    (1, f"before {TEXT.upper()} after"), (2, None), (3, ""), (4, "!!"), (5, "short ITEM"), (5, "short ITEM"),
    (6, "one two three"), (7, "x " * 30_000 + TEXT), (8, "a a a a a a a a a a a a"), (None, "short item"),
    (9, "Éa ÉA éa short item short item"),
]
ITEMS = [
    (10, TEXT), (2, "short item"), (2, "short item"), (33, "a " * 15), (4, None), (5, ""), (6, "..."), (None, "three"),
    (7, "éa Short"),
]


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 40])
def test_edges(spark, rows, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    docs = rows("doc_id long, text string, items int", *((*d, 1) for d in DOCS))
    items = rows("item_id long, text string", *ITEMS)
    got = decontaminate.digests(decontaminate.scan(docs, items)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(DOCS, ITEMS)
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    dirty = {r[0] for r in brute(DOCS, ITEMS) if r[-1]}
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in DOCS} - dirty
    cut = decontaminate.decontaminated(docs, items, spans=True).collect()
    assert len(cut) == len(DOCS)
    assert not any(r[-1] for r in brute([(r["doc_id"], r["text"]) for r in cut], ITEMS))
    assert {r["text"] for r in cut if r["doc_id"] == 1} == {"before \n after"}


def test_copies_do_not_outgrow_a_part(spark, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 100)
    many = [(k, f"w{k:03} " * 4) for k in range(60)] + [(1000, "a much repeated item")] * 30 + [(2000, "long " * 40)]
    items = rows("item_id long, text string", *many)
    parts = list(decontaminate._parts(items, 10))
    texts = dict(many)
    assert sorted(i for p in parts for i in p.item_ids) == sorted(texts)
    sizes = [sum(len(texts[i]) for i in p.item_ids) for p in parts]
    assert all(size <= 100 or p.item_ids == [2000] for size, p in zip(sizes, parts))
    assert len(parts) < 40


def test_empty_tables(spark, rows):
    docs, items = rows("doc_id long, text string", *DOCS), rows("item_id long, text string", *ITEMS)
    assert decontaminate.scan(docs.where("false"), items).count() == 0
    assert decontaminate.decontaminated(docs, items.where("false")).count() == len(DOCS)

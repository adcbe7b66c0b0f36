"""The Jaccard join against brute force over word shingles as text."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cowrie.llm import jaccard, signature_tree
from cowrie.llm.components import components
from cowrie.llm.queries import QUERIES
from cowrie.llm.shingles import shingles

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingled(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(docs, n, percent):
    """Sorted (doc_id, size, component_id) of (doc_id, text) with unique ids."""
    sets = {d: shingled(t, n) for d, t in docs}
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        for e in {e for x in s for e in where[x] if e < d}:
            both = len(s & sets[e])
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op5_ngram_jaccard_join"](spark, SF).collect())
    expected = brute(docs, 4, 85)
    assert got == expected
    assert len({c for _, _, c in expected}) < len(docs)


def families(seed, n, edits):
    """Texts of some families whose members differ by up to ``edits`` words."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 3)))
    bases = [[word() for _ in range(r.choice([1, 3, 5, 8, 12, 25, 60, 150]))] for _ in range(n // 8)]
    docs = []
    for k in range(n):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, edits)):
            at = r.randrange(len(w)) if w else 0
            r.choice([lambda: w.insert(at, word()), lambda: w.__setitem__(at, word()) if w else None, lambda: w and w.pop(at)])()
        docs.append((k * 3 + 1, " ".join(w)))
    return docs


@pytest.mark.parametrize("block,percent,n,edits", [(7, 80, 5, 2), (3, 85, 2, 6)])
def test_families_are_brute_force(spark, rows, monkeypatch, block, percent, n, edits):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "KEYS_TOGETHER", 2_000)
    monkeypatch.setattr(jaccard, "RARE", block)
    monkeypatch.setattr(jaccard, "SAMPLE", 20 * block)
    docs = families(block, 400, edits)
    df = rows("doc_id long, text string", *docs).repartition(5)
    got = sorted(tuple(r) for r in jaccard.groups(df, n, percent).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(docs, n, percent)
    kept = [r["doc_id"] for r in jaccard.deduplicated(df, n, percent).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute(docs, n, percent)} | {d for d, s, _ in brute(docs, n, percent) if not s})


def test_odd_rows(spark, rows):
    long = " ".join(f"w{k}" for k in range(30_000))
    docs = [(9, None), (8, ""), (7, " \n\t"), (6, "Only Three\nwords"), (5, "only three words"), (4, "ÉCOLE a b c"), (3, "école a b c"),
            (2, long), (1, long + " x"), (11, "a b"), (12, "a  b c")]
    df = rows("doc_id long, root int, n_shingles int, text string", *((d, 0, 0, t) for d, t in docs))
    got = jaccard.groups(df, 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(docs, 4, 85)
    kept = jaccard.deduplicated(df, 4, 85)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 7, 8, 9, 11, 12]
    assert jaccard.groups(df.where("false"), 4, 85).count() == 0
    assert jaccard.deduplicated(df.where("false")).count() == 0


def test_repeated_and_null_ids(spark, rows):
    text = "one two three four five six seven"
    df = rows("doc_id long, text string", (5, text), (5, text), (2, text), (None, text), (None, text), (3, "x y"), (3, "z"), (3, "z"), (None, None))
    got = sorted(map(tuple, jaccard.groups(df, 4, 85).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == sorted(
        [(5, 4, 2), (5, 4, 2), (2, 4, 2), (None, 4, None), (None, 4, None), (3, 1, 3), (3, 1, 3), (3, 1, 3), (None, 0, None)], key=repr
    )
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard.deduplicated(df, 4, 85).collect()), key=repr)
    assert kept == sorted([(2, text), (None, text), (None, text), (3, "x y"), (3, "z"), (None, None)], key=repr)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([80, 85]), st.integers(1, 400), st.data())
def test_linked_sets_share_a_key(percent, size, data):
    r = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
    b = a[r.permutation(len(a))[: len(a) - data.draw(st.integers(0, max(0, len(a) // 6)))]]
    b = np.unique(np.append(b, r.integers(0, 2**63, data.draw(st.integers(0, len(a) // 6))).astype(np.uint64)))
    common = np.sort(a[r.random(len(a)) < data.draw(st.sampled_from([0, 0.1, 0.9]))])
    if len(b) and signature_tree.linked(a, b, percent) and not np.array_equal(a, b):
        (one, chained), (other, too) = jaccard.keys(a, percent, common), jaccard.keys(b, percent, common)
        shared = np.intersect1d(one, other)
        assert len(shared) >= jaccard.SHARED or np.intersect1d(shared, np.append(one[chained], other[too])).size


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 3, 20, 300, 5000, 60_000]), st.sampled_from([50, 80, 85, 100]))
def test_sketches_of_linked_sets_allow_the_link(seed, size, percent):
    r = np.random.default_rng(seed)
    size = int(r.integers(1, size + 1))
    low, high = (1 << 16, 1 << 18) if seed % 3 == 0 else (0, 2**63)  # few buckets
    a = np.unique(r.integers(low, high, size).astype(np.uint64))
    b = a[r.permutation(len(a))[: len(a) - int(r.integers(0, len(a) // 5 + 1))]]
    b = np.unique(np.append(b, r.integers(low, high, int(r.integers(0, len(a) // 5 + 1))).astype(np.uint64)))
    one, other = np.array([jaccard.sketch(a)]), np.array([jaccard.sketch(b)])
    if signature_tree.linked(a, b, percent):
        assert jaccard.linkable(one, other, percent)[0] and jaccard.linkable(other, one, percent)[0]


def test_sketches_tell_sets_apart():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (30, 60, 100, 150)]
    for a in sets:
        b = np.unique(r.integers(0, 2**63, len(a)).astype(np.uint64))
        assert not jaccard.linkable(np.array([jaccard.sketch(a)]), np.array([jaccard.sketch(b)]), 85)[0]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 80))
def test_a_forest_connects_what_its_edges_do(seed, n):
    r = np.random.default_rng(seed)
    edges = r.integers(2**63, 2**63 + 40, (n, 2), dtype=np.uint64)
    slow = signature_tree.Groups(40)
    for x, y in (edges - np.uint64(2**63)).astype(int).tolist():
        slow.join(x, y)
    found = jaccard._forest(edges)
    ends = {int(y) - 2**63: int(x) - 2**63 for x, y in found}
    assert len(ends) == len(found)
    assert {x: ends.get(x, x) for x in range(40)} == dict(enumerate(slow.roots().tolist()))


def test_edges_grow_with_sets_not_pairs(spark, rows):
    r = random.Random(5)
    docs = []
    for family in range(30):
        base = [f"w{family}x{k}" for k in range(120)]
        docs += [base[:at] + [f"n{family}y{at}"] + base[at + 1 :] for at in r.sample(range(120), 14)]
    df = rows("doc_id long, text string", *((k, " ".join(w)) for k, w in enumerate(docs)))
    _, chains = jaccard._sets_and_chains(df, 4, 85)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert chains.count() <= (len(docs) - 30) * parts
    assert len({r["component_id"] for r in jaccard.groups(df, 4, 85).collect()}) == 30


def test_sets_with_empty_cells_share_a_key():
    tokens = np.arange(1, 41, dtype=np.uint64)  # all in the first cell
    other = tokens[1:]
    assert signature_tree.linked(tokens, other, 85)
    assert len(np.intersect1d(jaccard.keys(tokens, 85)[0], jaccard.keys(other, 85)[0]))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.booleans())
def test_tree_joins_what_brute_force_joins(seed, n, cross):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        s = set(sets[r.integers(len(sets))].tolist()) if sets and r.random() < 0.7 else set(r.integers(0, 2**63, r.integers(1, 200)).tolist())
        for _ in range(r.integers(0, 6)):
            s.add(int(r.integers(2**63))) if r.random() < 0.5 or len(s) < 2 else s.pop()
        sets.append(np.array(sorted(s), np.uint64))
    left, right = (np.arange(n // 2 + 1), np.arange(n // 2, n)) if cross else (np.arange(n), None)
    slow, fast = signature_tree.Groups(n), signature_tree.Groups(n)
    for x in left.tolist():
        for y in (left if right is None else right).tolist():
            if x != y and signature_tree.linked(sets[x], sets[y], 85):
                slow.join(x, y)
    for x, y in signature_tree.join(sets, left, right, 85):
        assert signature_tree.linked(sets[x], sets[y], 85)
        fast.join(x, y)
    assert slow.roots().tolist() == fast.roots().tolist()


@pytest.mark.parametrize("together", [500_000, 60])
def test_components(spark, rows, monkeypatch, together):
    monkeypatch.setattr("cowrie.llm.components.TOGETHER", together)
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(230)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    expected = sorted((x, find(x)) for x in list(root) if find(x) != x)
    assert sorted(map(tuple, components(rows("a long, b long", *edges)).collect())) == expected
    assert components(rows("a long, b long", (1, 1))).count() == 0


def test_shingles():
    assert len(shingles(None, 4)) == len(shingles(" \n", 4)) == 0
    assert np.array_equal(shingles("A b\tc", 4), shingles("a B\n\nc ", 4)) and len(shingles("a b c", 4)) == 1
    assert len(shingles("a b c d e a b c d", 4)) == 5
    assert np.array_equal(shingles("é x", 4), shingles("é  X", 4)) and not np.array_equal(shingles("É x", 4), shingles("é x", 4))


def test_columns_of_any_name_stay(rows):
    same = "one two three four five six seven eight nine ten"
    docs = rows(
        "_hash long, doc_id long, _set_id string, text string, root int, score double, _rank int",
        (1, 3, "a", same, 1, 1.0, 9), (2, 2, "b", same, 2, 2.0, 8), (3, 5, "c", "other words", 3, 3.0, 7), (4, None, "d", same, 4, 4.0, 6),
    )
    kept = jaccard.deduplicated(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [tuple(r) for r in docs.collect()[1:]]


def test_workers_forget_words(spark, rows):
    docs = rows("doc_id long, text string", *((k, f"word{k} a b c d e f") for k in range(50))).coalesce(1)
    jaccard.groups(docs, 4, 85).count()

    def kept(batches):
        import pyarrow as pa

        from cowrie.llm import shingles

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(shingles._HASHES)]})

    assert {r["n"] for r in spark.range(64, numPartitions=16).mapInArrow(kept, "n long").collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 40), st.booleans(), st.sampled_from([40, 80, 85]))
def test_signatures_connect_all_linked_sets(seed, n, cross, percent):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        s = set(sets[r.integers(len(sets))].tolist()) if sets and r.random() < 0.7 else set(r.integers(0, 2**63, r.integers(1, 400)).tolist())
        for _ in range(r.integers(0, 30)):
            s.add(int(r.integers(2**63))) if r.random() < 0.5 or len(s) < 2 else s.pop()
        sets.append(np.array(sorted(s), np.uint64))
    side = np.arange(n) % 2 if cross else np.zeros(n, int)
    edges = jaccard._connected(
        side, np.arange(n, dtype=np.uint64), np.array([len(s) for s in sets]), [jaccard.signature(s).tobytes() for s in sets], percent
    )
    found = signature_tree.Groups(n)
    for x, y in edges.astype(int).tolist():
        found.join(x, y)
    for x in range(n):
        for y in range(x):
            if (not cross or side[x] != side[y]) and signature_tree.linked(sets[x], sets[y], percent):
                assert found.find(x) == found.find(y)


def test_signatures_tell_unlike_sets_apart():
    r = np.random.default_rng(0)
    for n in (26, 100, 400, 5_000, 15_000):
        a, b = (np.unique(r.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(2))
        one, other = jaccard.signature(a), jaccard.signature(b)
        assert not jaccard.close(one[None], other[None], np.array([len(a)]), np.array([len(b)]), 80)[0, 0]
        assert jaccard.close(one[None], one[None], np.array([len(a)]), np.array([len(a)]), 80)[0, 0]


def test_packed_keys_keep_what_tells_them_apart():
    r = np.random.default_rng(1)
    parts, part = 7, 3
    key = r.integers(0, 2**40, 100, dtype=np.uint64) * np.uint64(parts) + np.uint64(part)
    node = r.integers(0, 2**64, 100, dtype=np.uint64) & np.uint64(jaccard._NODE) | np.where(r.random(100) < 0.5, jaccard._ONE, np.uint64(0))
    seen = r.integers(0, 2**64, 100, dtype=np.uint64)
    packed = jaccard._packed(key, node, seen, parts)
    assert packed.shape == (100, 19)
    got = jaccard._unpacked(part, packed.tobytes())
    assert (got[:, 1] == node).all() and (got[:, 2] == seen).all()
    assert (got[:, 0] == key // np.uint64(parts) + np.uint64(part << 40)).all()


def short_texts(seed, n):
    """Texts of a few sentences out of some that occur all over: hardly a token of theirs is rare."""
    r = random.Random(seed)
    sentences = [" ".join(f"s{k}w{j}" for j in range(8)) for k in range(40)]
    return [(k, " ".join(r.sample(sentences, 4))) for k in range(n)]


@pytest.mark.parametrize("signatures", [4_000, 20])
def test_sets_chained_for_lack_of_rare_tokens_part(spark, rows, monkeypatch, signatures):
    monkeypatch.setattr(jaccard, "SIGNATURES", signatures)
    monkeypatch.setattr(jaccard, "BLOCK", 30)
    docs = short_texts(3, 250)
    docs += [(1000 + k, text + " more") for k, text in docs[:40]]
    shuffled, real = [], jaccard._gathered
    monkeypatch.setattr(jaccard, "_gathered", lambda goes: shuffled.append(goes.count()) or real(goes))
    df = rows("doc_id long, text string", *docs)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.groups(df, 4, 85).collect())
    assert got == brute(docs, 4, 85)
    assert sum(shuffled) <= 120  # 40 pairs, and few more

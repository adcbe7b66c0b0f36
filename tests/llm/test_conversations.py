"""Conversation repair against a shortest-path search over whole edit scripts, and against SQL."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cowrie.llm import conversations

from against_sql import same_as_sql

GRAMMAR = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s|s?(ua)*u?)?")
BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = text.strip(BLANKS)
        if not body:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def search(rows, fault):
    """Dijkstra over (rows used, initials so far) by (cost, letters): no states, no backpointers."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, initials, lines = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, letters, "\n".join(lines)
        # the grammar sees no further back than the last initial and whether there is one
        if (at, initials[-1:]) in done and (at, initials[-1:], cost, letters) not in done:
            continue
        done |= {(at, initials[-1:]), (at, initials[-1:], cost, letters)}

        def go(price, letter, used, initial, line):
            grown = initials + initial
            if PREFIX.fullmatch(grown) and len(grown) <= 2 * len(rows) + 4:
                heapq.heappush(heap, (cost + price, letters + letter, at + used, grown, lines + ((line,) if line is not None else ())))

        for role in ("user", "assistant"):
            go(3, "I", 0, role[0], f"{role}:")
        if at < len(rows):
            role, text = rows[at][2:]
            go(4, "D", 1, "", None)
            if fault[at] not in ("blank", "duplicate"):
                extra = 3 if fault[at] == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    go(extra, "K", 1, role[:1], f"{role}:{text}")
                for other in ("user", "assistant"):
                    go(3 + extra, "R", 1, other[0], f"{other}:{text}")


def expected(all_rows, damaging=True):
    got = {}
    ids = {r[0] for r in all_rows}
    spaced = [(c, t, *(" " if v is None else v for v in rest)) for c, t, *rest in all_rows]
    kept = damage(all_rows) if damaging else spaced
    for conv in ids:
        rows = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        fault = faults(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        initials = [r[2][:1] for r in rows]
        cost, letters, text = search(rows, fault)
        got[conv] = (
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            fault.count("blank"), fault.count("duplicate"), fault.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, sha(text),
        )
    return got


def by_id(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def test_query_equals_sql(spark):
    same_as_sql(spark, "op11_conversation_repair")


def test_whole_table_against_search(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = by_id(conversations.digests(conversations.damaged(turns), "lost"))
    assert got == expected([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, rows, seed):
    draw = random.Random(seed)
    made = []
    for conv in range(150):
        for _ in range(draw.randint(0, 7)):
            made.append((
                draw.choice([None, conv]) if conv < 3 else conv, draw.choice([None, -3, 0, 1, 2, 3, 4, 5, 90]),
                draw.choice(["system", "user", "assistant", "tool", "", None, "User", "s"]),
                draw.choice(["", " \n", "One.", "Two", "Three! ", "é?\t", "cut off é", None, "x.\x0b", "a\nb.", "Two"]),
            ))
    turns = rows("conv_id long, turn long, role string, text string", *made)
    whole = by_id(conversations.digests(turns))
    assert whole == expected(made, damaging=False)
    assert by_id(conversations.digests(conversations.damaged(turns), "lost")) == expected(made)


def test_edits_are_the_repair(spark):
    turns = conversations.damaged(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    summed = by_id(conversations.digests(turns, "lost"))
    edits = {}
    for r in conversations.repair(turns, "lost").collect():
        edits.setdefault(r["conv_id"], []).append(r)
    assert set(edits) == set(summed)
    for conv, rows in edits.items():
        rows.sort(key=lambda r: r["step"])
        assert [r["step"] for r in rows] == list(range(len(rows)))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in rows if r["role"] is not None)
        assert (sum(r["cost"] for r in rows), "".join(r["edit"] or "" for r in rows), sha(text)) == summed[conv][-3:]
        assert GRAMMAR.fullmatch("".join(r["role"][0] for r in rows if r["role"]))


def test_steps_of_all_short_scripts():
    """Each kind of row from every state, against the search over scripts of up to three rows."""
    kinds = [("s", 0), ("u", 0), ("a", 0), ("x", 0), ("u", 3), ("a", 1)]
    texts = {0: "t{}.", 1: "", 3: "t{}"}
    for script in itertools.product(kinds, repeat=3):
        rows = [(0, k, {"s": "system", "u": "user", "a": "assistant", "x": "x"}[r], texts[f].format(k)) for k, (r, f) in enumerate(script)]
        costs = conversations._END
        for initial, fault in reversed(script):
            costs, _ = conversations.stepped(costs, initial, fault)
        assert costs[conversations.EMPTY] == search(rows, faults(rows))[0]


def test_batches_and_slices_do_not_matter(spark, monkeypatch):
    """One giant conversation over many Arrow batches, with others around it."""
    turns = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 7 < 4, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text "), (F.col("id") % 1700).cast("string"), F.when(F.col("id") % 11 == 0, "").otherwise(".")).alias("text"),
    )
    before = by_id(conversations.digests(turns))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert by_id(conversations.digests(turns)) == before
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    small = turns.where("conv_id <> 7")
    assert {k: v for k, v in before.items() if k != 7} == by_id(conversations.digests(small))


def test_edges(spark, rows):
    ddl = "conv_id long, turn int, role string, text string, lost boolean, _best string, step int, audit int"
    extra = (None, "x", 1, 1)
    turns = rows(
        ddl, (1, 0, "user", "Hi.", *extra), (1, 0, "user", "Hi.", *extra), (1, None, None, None, *extra),
        (2, 5, "assistant", "é " * 200_000 + "end.", *extra), (None, 1, "user", "Q?", *extra), (None, 2, "assistant", "A.", *extra),
        (3, 1, "user", "gone.", True, "x", 1, 1),
    )
    got = by_id(conversations.digests(turns, "lost"))
    assert got[1][1:8] == (0, 1, 1, 0, 2, 11, "DKDI")
    assert got[2][6:8] == (3, "IK")
    assert got[None][1:] == (0, 0, 0, 0, 0, 0, "KK", sha("user:Q?\nassistant:A."))
    assert got[3] == (3, 0, 0, 0, 0, 0, 0, "", sha(""))
    gone = [tuple(r) for r in conversations.repair(turns, "lost").where("conv_id = 3").collect()]
    assert gone == [(3, 0, None, 0, None, None, None, None, None)]
    none = turns.where("false")
    assert conversations.digests(none).count() == 0 and conversations.repair(none).count() == 0
    assert conversations.digests(conversations.damaged(none), "lost").count() == 0
    assert conversations.damaged(turns).columns == ["conv_id", "turn", "role", "text", "lost"]

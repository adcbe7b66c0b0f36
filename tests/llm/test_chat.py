"""Chat formatting against SQL and a plain-Python formatter's source turns."""

import hashlib

from against_sql import same_as_sql

from cowrie.llm import chat

NASTY = [
    "", "\\", "\\\\", "\\b\\l\\h", "### ", "###", "a</turn>", "</turn>\n### user: b", "</turn", "</turn</turn>", "# <b> \\n",
    ": x: ", "\n\n", "é\U0001f600### é", "### assistant\\: x</turn>\n", "\\### Assistant: </turn> ok", "ends in \\",
]


def test_query(spark):
    same_as_sql(spark, "op9_chat_formatting")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(got, conversations):
    assert {r["conv_id"] for r in got} == set(conversations) and len(got) == len(conversations)
    for r in got:
        turns = [(role or "", text or "") for role, text in conversations[r["conv_id"]]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_nasty_turns(spark, rows):
    conversations = {
        1: [("assistant", t) for t in NASTY],
        2: [(role, "hi") for role in ["user", "a: b", "### ", "x\\", "", None, "</turn>", "\\c", "assistant\\"]],
        3: [("assistant", None)],
        4: [("user", "x" * 100_000 + "### "), ("assistant", "y\\" * 50_000)],
    }
    flat = [(c, k, role, text, 1) for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    df = rows("conv_id long, turn int, role string, text string, formatted int", *reversed(flat))
    formatted = chat.format_turns(df)
    check(chat.digests(formatted).collect(), conversations)
    for r in formatted.collect():
        assert r["formatted"].count("\n") >= len(conversations[r["conv_id"]])


def test_unconflicting_text_stays_readable(rows):
    df = rows("conv_id long, turn int, role string, text string", (1, 0, "user", "a <b> # \\x"), (1, 1, "assistant", "### no"))
    [r] = chat.format_turns(df).collect()
    assert r["formatted"] == "### user: a <b> # \\x</turn>\n### assistant\\: \\h\\h\\h no</turn>\n"
    [span] = r["loss_spans"]
    assert r["formatted"][span["begin"] : span["end"]] == "\\h\\h\\h no" and span["escaped"]


def test_ties_nulls_repeats_and_empty(spark, rows):
    flat = [(None, 0, "user", "a"), (5, None, "user", "first"), (5, 1, "user", "b"), (5, 1, "assistant", "c"), (5, 1, "user", "b")]
    df = rows("conv_id long, turn int, role string, text string", *flat)
    expected = {None: [("user", "a")], 5: [("user", "first"), ("assistant", "c"), ("user", "b"), ("user", "b")]}
    check(chat.digests(chat.format_turns(df)).collect(), expected)
    assert chat.digests(chat.format_turns(df.where("false"))).count() == 0


def test_no_python_in_the_plan(rows):
    df = rows("conv_id long, turn int, role string, text string", (1, 0, "user", "a"))
    text = chat.digests(chat.format_turns(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))

"""Licence scans against SQL and a plain-Python scan."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from against_sql import same_as_sql

from cowrie.llm import licenses


def test_query(spark):
    same_as_sql(spark, "op7_license_scan")


NOTICES, TEXTS = licenses.Templates(licenses.NOTICES, licenses.SENTENCE), licenses.Templates(licenses.TEXTS, licenses.WHOLE)


def cosine(text, statement, templates):
    a, b = licenses.words_of(text), licenses.words_of(statement)
    weigh = lambda words: {w: (1 + math.log(n)) * templates.idf.get(w, templates.other) for w, n in Counter(words).items()}
    va, vb = weigh(a), weigh(b)
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    return round(sum(va[w] * vb[w] for w in va if w in vb) / (norm(va) * norm(vb)), 4) if va and vb else 0


def best(texts, templates):
    found = [(-cosine(t, s, templates), name) for t in texts for name, s in templates.texts]
    found = [(-x, name) for x, name in sorted(found) if -x >= templates.least]
    return found[0] if found else None


def pieces(text):
    end = "([0-9]|[^ \t\n\r\f][^ \t\n\r\f])([.!?])[ \t\n\r\f]+"
    return re.sub(end, "\\1\\2\x01", text).split("\x01") + text.split("\n")


def brute(files):
    own, speaks = {}, {}
    for doc_id, path, text in files:
        whole, header = best([text or ""], TEXTS), best(pieces(text or ""), NOTICES)
        own[doc_id] = ("file", whole) if whole else ("header", header) if header else None
        if whole and path is not None:
            directory = path.rpartition("/")[0]
            speaks.setdefault(directory, []).append((-whole[0], whole[1]))
    out = set()
    for doc_id, path, _ in files:
        how = own[doc_id]
        if how:
            out.add((doc_id, path, how[1][1], how[0], how[1][0], path))
            continue
        at = path.rpartition("/")[0] if path is not None else None
        while at is not None and at not in speaks:
            at = at.rpartition("/")[0] if at else None
        if at is None:
            out.add((doc_id, path, None, "none", 0.0, None))
        else:
            score, name = min(speaks[at])
            out.add((doc_id, path, name, "inherited", -score, at))
    return out


MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
WHOLE = {name: text for name, text in licenses.TEXTS}
FILES = [
    (1, "a/LICENSE", WHOLE["MIT"].upper()), (2, "a/b/c/x", "plain text"), (3, "a/b/COPYING", f"GNU\n\n{WHOLE['GPL-3.0']}\n"), (4, "a/b/y", f"words here. {MIT} more"),
    (5, "a/z", None), (6, "top", ""), (7, "e/f", "the license of the work"), (8, None, "no path"), (9, None, MIT),
    (10, "g/LICENSE", WHOLE["ISC"]), (11, "g/COPYING", WHOLE["BSD-2-Clause"]), (12, "g/h", "x"), (13, "a//w", "x"), (14, "/abs/q", "x"),
    (15, "k/long", "word " * 40_000 + "\n" + GPL + "\n" + "word " * 40_000), (16, "k/m", "!?. . ."), (17, "a/b", "bare"),
]


def test_tree_is_brute_force(rows):
    df = rows("doc_id long, path string, text string, license int, key int", *((*f, 1, 2) for f in FILES))
    assert set(map(tuple, licenses.scan(df).collect())) == brute(FILES)


def test_root_speaks_for_all(rows):
    files = [*FILES, (20, "LICENSE", WHOLE["Apache-2.0"])]
    got = licenses.scan(rows("doc_id long, path string, text string", *files)).collect()
    assert set(map(tuple, got)) == brute(files)
    assert {r["found_in"] for r in got if r["doc_id"] in (5, 6)} == {"a", ""}


def test_repeats_nulls_and_empty(rows):
    df = rows("doc_id long, path string, text string", (1, "a/b", WHOLE["MIT"]), (1, "a/b", WHOLE["MIT"]), (None, "a/c", "x"), (None, None, None))
    got = [tuple(r) for r in licenses.scan(df).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, "a/b", "MIT", "file", 1.0, "a/b")] * 2 + [(None, "a/c", "MIT", "inherited", 1.0, "a"), (None, None, None, "none", 0.0, None)],
        key=repr,
    )
    assert licenses.scan(df.where("false")).count() == 0


@pytest.mark.parametrize("templates", [NOTICES, TEXTS], ids=["notices", "texts"])
def test_bounds_let_all_matches_pass(rows, templates):
    statements = [s for _, s in templates.texts]
    words = sorted({w for s in statements for w in licenses.words_of(s)}) + ["alpha", "beta", "and"]
    r = random.Random(1)
    texts = []
    for statement in statements:
        own = licenses.words_of(statement)
        for _ in range(25):
            texts.append(" ".join(r.sample(own, r.randint(len(own) // 6 + 1, len(own))) + r.choices(words, k=r.randint(0, len(own) // 3))))
    df = rows("k int, folded string", *enumerate(texts))
    left = {t["folded"] for t in df.where(templates.may_match(licenses._words("folded"))).collect()}
    like = {t for t in texts if max(cosine(t, s, templates) for s in statements) >= templates.least}
    assert like and like <= left and len(left) < len(set(texts))


def test_folding_leaves_the_words_of_folded_ascii(rows):
    """Of every character between two letters, also those whose lower case holds a letter."""
    every = [f"A{chr(c)}Z" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    lots = [every[k : k + 1000] for k in range(0, len(every), 1000)]
    df = rows("k int, lot array<string>", *enumerate(lots))
    got = {r["k"]: r["w"] for r in df.select("k", F.transform("lot", lambda t: licenses._words(licenses._folded(t))).alias("w")).collect()}
    ascii_lower = {c: c + 32 for c in range(65, 91)}
    assert got == {k: [re.split(licenses._WORDS, t.translate(ascii_lower)) for t in lot] for k, lot in enumerate(lots)}


def test_words_are_split_once_for_all_bounds(rows):
    """The split stood in the filter of pieces more than a hundred times, and ran as often for each piece."""
    df = rows("folded string", (MIT,))
    text = df.where(NOTICES.may_match(licenses._words("folded")))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1


GPL_HEADER = """/* Copyright 2020 Someone
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version. */
int main() { return 0; }
"""


def test_what_files_really_say(rows):
    """Notices among other words, headers of source files, whole licence files, and what is none."""
    other = "other words " * 20
    mit_file = f"The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n\n{WHOLE['MIT']}"
    said = {
        "BSD-3-Clause header": f"{other}end. Redistribution and use in source and binary forms, with or without modification, are permitted. {other}",
        "MPL-2.0 header": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. */\nint x;",
        "MIT header": licenses._MIT_GRANT,
        "MIT header ": f"# SPDX-License-Identifier: MIT\nimport x\n{other}",
        "GPL-3.0 header": GPL_HEADER,
        "CC-BY-4.0 header": f"{other}\nThis work is licensed under a Creative Commons Attribution 4.0 International License.",
        "MIT header  ": "xx yy Released under the MIT License.",
        "MIT file": mit_file,
        "GPL-2.0 file": WHOLE["GPL-2.0"].replace("you can", "you\ncan"),
        "BSD-3-Clause file": f"Copyright 2020, Someone\n{WHOLE['BSD-3-Clause']}",
        "none": f"The license of this work is unknown. {other}",
    }
    files = [(k, f"{k}/x", text) for k, text in enumerate(said.values())]
    got = {tuple(r) for r in licenses.scan(rows("doc_id long, path string, text string", *files)).collect()}
    assert got == brute(files)
    assert [f"{r[2]} {r[3]}" for r in sorted(got)] == [s.strip() if s != "none" else "None none" for s in said]


def test_own_templates(rows):
    df = rows("doc_id long, path string, text string", (1, "a/x", "Use it as you like, says Someone."), (2, "a/y", "no"), (3, "b/z", MIT))
    got = licenses.scan(df, [("Own", "Use it as you like.")], [("Own", "Use it as you like, says Someone.")]).collect()
    assert {(r["doc_id"], r["license"], r["how"]) for r in got} == {(1, "Own", "file"), (2, "Own", "inherited"), (3, None, "none")}


def test_no_python_in_the_plan(rows):
    text = licenses.scan(rows("doc_id long, path string, text string", (1, "a", "x")))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))

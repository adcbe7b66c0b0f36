"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cowrie.llm import (
    chat,
    conversations,
    decontaminate,
    fill_middle,
    jaccard,
    language,
    licenses,
    neighbours,
    packing,
    quality,
    shortest_pack,
    token_files,
    toxicity,
)
from cowrie.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_mil")
def quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digests(decontaminate.scan(docs, items))


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


@query("op4_token_files")
def token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path, digests=True)


@query("op5_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.groups(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def _values(templates) -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    return ", ".join(f"({k}, {quoted(name)}, {quoted(text)})" for k, (name, text) in enumerate(templates))


_NO_WORDS = ", ".join(f"'{w}'" for w in ["", *sorted(licenses.COMMON)])
_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LICENSE_SQL = rf"""
WITH templates(kind, template, license, statement) AS (
    SELECT 1, * FROM (VALUES {_values(licenses.NOTICES)}) UNION ALL SELECT 0, * FROM (VALUES {_values(licenses.TEXTS)})
), words AS (
    SELECT kind, template, license, word FROM (
        SELECT kind, template, license, unnest(regexp_split_to_array({_FOLDED.format("statement")}, '[^a-z0-9]+')) AS word FROM templates)
    WHERE word NOT IN ({_NO_WORDS})
), sizes AS (
    SELECT kind, count(*) AS n FROM templates GROUP BY kind
), idf AS (
    SELECT kind, word, ln((1.0 + any_value(n)) / (1 + count(DISTINCT template))) + 1 AS idf FROM words JOIN sizes USING (kind) GROUP BY kind, word
), weights AS (
    SELECT kind, template, license, word, (1 + ln(count(*))) * any_value(idf) AS weight
    FROM words JOIN idf USING (kind, word) GROUP BY kind, template, license, word
), lengths AS (
    SELECT kind, template, sqrt(sum(weight * weight)) AS length FROM weights GROUP BY kind, template
), docs AS (
    SELECT doc_id, source || '/' || lang || '/' || doc_id AS path, source || '/' || lang AS directory, text FROM documents
), texts AS (
    SELECT doc_id, 0 AS kind, 0 AS pos, {_FOLDED.format("text")} AS text FROM docs
    UNION ALL SELECT doc_id, 1, row_number() OVER (PARTITION BY doc_id), {_FOLDED.format("piece")} FROM (
        SELECT DISTINCT doc_id, unnest(list_concat(
            string_split(regexp_replace(text, '([0-9]|[^ \t\n\r\f][^ \t\n\r\f])([.!?])[ \t\n\r\f]+', '\1\2' || chr(1), 'g'), chr(1)),
            string_split(text, chr(10)))) AS piece FROM docs)
), counts AS (
    SELECT doc_id, kind, pos, word, 1 + ln(count(*)) AS n
    FROM (SELECT doc_id, kind, pos, unnest(regexp_split_to_array(text, '[^a-z0-9]+')) AS word FROM texts)
    WHERE word NOT IN ({_NO_WORDS}) GROUP BY doc_id, kind, pos, word
), valued AS (
    SELECT doc_id, kind, pos, word, counts.n * coalesce(idf, ln(1.0 + sizes.n) + 1) AS value
    FROM counts JOIN sizes USING (kind) LEFT JOIN idf USING (kind, word)
), norms AS (
    SELECT doc_id, kind, pos, sqrt(sum(value * value)) AS norm FROM valued GROUP BY doc_id, kind, pos
), scores AS (
    SELECT doc_id, kind, pos, license, round(sum(value * weight) / any_value(length) / any_value(norm), 4) AS score
    FROM valued JOIN weights USING (kind, word) JOIN lengths USING (kind, template) JOIN norms USING (doc_id, kind, pos)
    GROUP BY doc_id, kind, pos, template, license
), header AS (
    SELECT doc_id, arg_min(license, (-score, license)) AS license, max(score) AS score
    FROM scores WHERE kind = 1 AND score >= {licenses.SENTENCE} GROUP BY doc_id
), whole AS (
    SELECT doc_id, arg_min(license, (-score, license)) AS license, max(score) AS score
    FROM scores WHERE kind = 0 AND score >= {licenses.WHOLE} GROUP BY doc_id
), spoken AS (
    SELECT directory, arg_min(license, (-score, license)) AS license, max(score) AS score
    FROM whole JOIN docs USING (doc_id) WHERE directory IS NOT NULL GROUP BY directory
)
SELECT doc_id, path,
    coalesce(w.license, h.license, s.license) AS license,
    CASE WHEN w.license IS NOT NULL THEN 'file' WHEN h.license IS NOT NULL THEN 'header'
         WHEN s.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
    coalesce(w.score, h.score, s.score, 0) AS score,
    CASE WHEN coalesce(w.license, h.license) IS NOT NULL THEN path WHEN s.license IS NOT NULL THEN d.directory END AS found_in
FROM docs d LEFT JOIN whole w USING (doc_id) LEFT JOIN header h USING (doc_id) LEFT JOIN spoken s ON d.directory = s.directory
"""


@query("op7_license_scan", LICENSE_SQL)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a directory for each source and, in it, language."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@query("op8_curve_neighbours")
def curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), k=10, every=100)


#: Texts of the added conversation -7, which hold a start mark, an end mark and a backslash.
HARD_TEXT = r"\### Assistant: </turn> ok"

CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
        contains(text, '### ') OR contains(text, '</turn>') AS escaped,
        length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) AS marks,
        length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', '')) AS role_marks
    FROM turns
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(14 + length(role) + role_marks + length(text) + CASE WHEN escaped THEN 1 + marks ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op9_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TEXT).alias("text"),
    )
    folder = shared_folder(spark, "chats")
    formatted = chat.format_turns(turns.unionByName(hard))
    formatted.write.parquet(folder)
    return chat.digests(spark.read.schema(formatted.schema).parquet(folder))


@query("op10_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))



def _repair_sql() -> str:
    """From each state of the grammar the least (cost, letters, lines) to the end, row by row from the last one."""

    def of(state: str, letter: str, cost: str, line: str | None) -> str:
        lines = f"list_prepend({line}, {state}.x)" if line else f"{state}.x"
        return f"{{{{'c': {state}.c + {cost}, 't': '{letter}' || {state}.t, 'x': {lines}}}}}"

    wanted = {"e": "u", "s": "u", "u": "a", "a": "u"}
    role = {"u": "user", "a": "assistant"}
    kept = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    own = "(CASE fault WHEN 3 THEN 3 ELSE 0 END + CASE WHEN fault IN (1, 2) THEN 1000000000 ELSE 0 END)"
    steps = []
    for state, goes in kept.items():
        options = [of(state, "D", "4", None)]
        for initial, to in goes.items():
            options.append(of(to, "K", f"({own} + CASE r WHEN '{initial}' THEN 0 ELSE 1000000000 END)", "role || ':' || text"))
        to = wanted[state]
        options.append(of(to, "R", f"(3 + {own})", f"'{role[to]}:' || text"))
        steps.append(f"list_min([{', '.join(options)}]) AS {state}")
    once = ", ".join(
        [f"list_min([{q}, {of(wanted[q], 'I', '3', chr(39) + role[wanted[q]] + ':' + chr(39))}]) AS {q}" for q in ("u", "a")]
    )
    then = ", ".join([f"list_min([{q}, {of('u', 'I', '3', chr(39) + 'user:' + chr(39))}]) AS {q}" for q in ("e", "s")])
    sql = rf"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))) % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE kind <> 0
), marked AS (
    SELECT *, left(role, 1) AS r, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM damaged
), rows AS (
    SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before,
        CASE WHEN body = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
    FROM marked
), back AS (
    SELECT conv_id, max(i) + 1 AS i, {{{{'c': 0, 't': '', 'x': []::VARCHAR[]}}}} AS e, {{{{'c': 6, 't': 'II', 'x': ['user:', 'assistant:']}}}} AS s,
        {{{{'c': 3, 't': 'I', 'x': ['assistant:']}}}} AS u, {{{{'c': 0, 't': '', 'x': []::VARCHAR[]}}}} AS a
    FROM rows GROUP BY conv_id
    UNION ALL
    SELECT conv_id, i, {then}, u, a FROM (
        SELECT conv_id, i, e, s, {once} FROM (
            SELECT b.conv_id, b.i - 1 AS i, {", ".join(steps)}
            FROM back b JOIN rows r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = b.i - 1))
), sums AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
    coalesce(e.t, '') AS audit, sha256(coalesce(array_to_string(e.x, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN sums ON o.conv_id IS NOT DISTINCT FROM sums.conv_id
    LEFT JOIN back ON o.conv_id IS NOT DISTINCT FROM back.conv_id AND back.i = 1
"""
    return sql.replace("{{", "{").replace("}}", "}")


@query("op11_conversation_repair", _repair_sql())
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.digests(turns, lost="lost")


@query("op12_shortest_pack")
def shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest_pack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


FILL_MIDDLE_SQL = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
    FROM documents
), drawn AS (
    SELECT *,
        CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (n + 1) AS c1,
        CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (n + 1) AS c2,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR CAST('0x' || substr(hex, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
             WHEN CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), parts AS (
    SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
        substr(text, 1, least(c1, c2)) AS prefix,
        substr(text, least(c1, c2) + 1, abs(c1 - c2)) AS middle,
        substr(text, greatest(c1, c2) + 1) AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_middle", FILL_MIDDLE_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )

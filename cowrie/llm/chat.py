r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered as ``### role: text</turn>\n`` for each turn.  The parser
cuts at every ``### ``, takes the role up to the first ``: `` and the text up to the
first ``</turn>``.  A turn that doesn't parse back to itself is escaped: ``\``, ``<`` and
``#`` of its text become ``\b``, ``\l`` and ``\h``, and a ``\`` after the role says so.
Roles are always written with these escapes and ``\c`` for a colon.  What has been
rendered is parsed again and compared with the source; anything else fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, AFTER_ROLE, END = "### ", ": ", "</turn>"
LEARNED = "assistant"

# Each escape is a backslash and a letter; the backslash itself is escaped first and
# restored last, so that plain replacements undo each other.
_TEXT = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
_ROLE = (*_TEXT, (":", "\\c"))


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, role: bool = False) -> Column:
    return _replaced(text, _ROLE if role else _TEXT)


def unescape(text: Column, role: bool = False) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(_ROLE if role else _TEXT)])


def render(role: Column, text: Column, escaped: Column) -> Column:
    """One turn; ``escaped`` says whether its text is written with escapes."""
    mark = F.when(escaped, F.lit("\\")).otherwise(F.lit(""))
    body = F.when(escaped, escape(text)).otherwise(text)
    return F.concat(F.lit(START), escape(role, True), mark, F.lit(AFTER_ROLE), body, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """``role, text`` of the turns of a rendered conversation, in order."""
    pieces = F.slice(F.split(formatted, START, -1), 2, 1 << 30)  # before the first mark there is nothing

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, AFTER_ROLE, 1)
        body = F.substring_index(_behind(piece, F.length(head) + len(AFTER_ROLE)), END, 1)
        escaped = head.endswith("\\")
        role = F.when(escaped, F.left(head, F.length(head) - 1)).otherwise(head)
        return F.struct(
            unescape(role, True).alias("role"), F.when(escaped, unescape(body)).otherwise(body).alias("text")
        )

    return F.transform(pieces, turn)


def _behind(text: Column, n: Column) -> Column:
    return F.substring(text, n + 1, F.length(text))


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans`` of ``turns (conv_id, turn, role, text)``.

    Turns come in ascending order, null ones first, ties by role, then text; a repeated
    row is a turn of its own.  Null roles and texts are empty.  Rows without a
    ``conv_id`` form one conversation.  Other columns are ignored, empty tables give
    empty results.  ``loss_spans`` are ``begin, end`` of the assistant's texts in
    characters of ``formatted``, with ``escaped`` where they are written with escapes.

    A conversation becomes one text, so its turns meet in one row by definition.
    """
    cleaned = turns.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    plain = parse(render(F.col("role"), F.col("text"), F.lit(False)))
    tried = cleaned.withColumn("escaped", ~(plain == source))
    rendered = tried.withColumn("rendered", render(F.col("role"), F.col("text"), F.col("escaped")))
    # the running length has the order and the partitioning of the grouping: one shuffle
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    ended = rendered.withColumn("end", F.sum(F.length("rendered")).over(so_far))
    row = F.struct("turn", "role", "text", "end", "escaped", "rendered")
    collected = ended.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    written = collected.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
    # the conversation as a whole must give back what went in
    same = parse(F.col("formatted")) == F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation doesn't parse back: "), F.col("conv_id").cast("string")))
    )
    return written.select("conv_id", checked.alias("formatted"), _spans().alias("loss_spans"))


def _spans() -> Column:
    """Spans of the learned turns: from behind the role to before the end mark."""

    def span(t: Column) -> Column:
        lead = F.length(F.substring_index(t["rendered"], AFTER_ROLE, 1)) + len(AFTER_ROLE)
        begin = t["end"] - F.length(t["rendered"]) + lead
        return F.struct(
            begin.cast("int").alias("begin"), (t["end"] - len(END) - 1).cast("int").alias("end"), t["escaped"].alias("escaped")
        )

    return F.transform(F.filter("turns", lambda t: t["role"] == LEARNED), span)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of formatted conversations gets back: turns, and all text under the loss mask."""
    turns = parse(F.col("formatted"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")

    def under(span: Column) -> Column:
        body = F.substring(F.col("formatted"), span["begin"] + 1, span["end"] - span["begin"])
        return F.when(span["escaped"], unescape(body)).otherwise(body)

    loss = F.array_join(F.transform("loss_spans", under), "")
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
